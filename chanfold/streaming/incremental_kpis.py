"""Incremental gold layer with Structured Streaming.

Silver fact files that land in a folder over time (new channel batches, new
months) update the additive KPI cube; every gold cut is then a roll-up of
the cube (``chanfold.operators.kpis.rollup_cut``).  The streaming state is
the cube itself -- one row per (country, channel, category, month, member)
cell -- so it is bounded by the dimension domains, not by the data volume.

Each micro-batch writes the complete cube (``complete`` output mode into
``foreachBatch``) as a new version folder that readers switch to only once it
is complete; the checkpoint folder makes the query restartable after a
failure without double counting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, StructField, StructType

from chanfold.operators.conform import FACT_SCHEMA
from chanfold.operators.kpis import CUBE_DIMS, kpi_partials

FACT_EUR_SCHEMA = StructType(FACT_SCHEMA.fields + [
    StructField("revenue_eur", DoubleType()), StructField("unit_price_eur", DoubleType())])


def cube_stream(spark: SparkSession, fact_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming KPI cube over the silver files arriving in ``fact_dir``."""
    reader = spark.readStream.schema(FACT_EUR_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return kpi_partials(reader.parquet(fact_dir), CUBE_DIMS)


def _versions(spark: SparkSession, cube_dir: str) -> list[tuple[int, str]]:
    """Complete cube versions under ``cube_dir`` as (batch id, path), oldest first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(cube_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append((int(name[2:]), st.getPath().toString()))
    return sorted(out)


def read_latest_cube(spark: SparkSession, cube_dir: str) -> DataFrame:
    """The most recent complete cube version."""
    versions = _versions(spark, cube_dir)
    if not versions:
        raise FileNotFoundError(f"no complete cube version under {cube_dir}")
    return spark.read.parquet(versions[-1][1])


def start_cube_refresh(spark: SparkSession, fact_dir: str, cube_dir: str, checkpoint_dir: str,
                       available_now: bool = True, keep_versions: int = 2) -> StreamingQuery:
    """Keep a cube of all files seen so far under ``cube_dir``.

    Each micro-batch writes the complete cube as a new version folder
    ``v=<batch id>``; readers take the newest version that has a ``_SUCCESS``
    marker, so they never see a half-written cube, and a retried batch only
    rewrites its own version.  Older versions beyond ``keep_versions`` are
    removed after a successful write.  With ``available_now`` the query
    processes what is there and stops (a scheduled incremental refresh);
    otherwise it runs continuously."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{cube_dir}/v={batch_id:010d}")
        jvm = spark.sparkContext._jvm
        for _, path in _versions(spark, cube_dir)[:-keep_versions]:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    writer = (cube_stream(spark, fact_dir).writeStream.outputMode("complete")
              .option("checkpointLocation", checkpoint_dir).foreachBatch(write_batch))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
