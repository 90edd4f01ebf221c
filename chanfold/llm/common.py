"""Helpers shared by the operators of this subpackage.

Intermediate tables that are read more than once are written as Parquet to
the shared folder the cluster names in ``spark.checkpoint.dir`` (see
``chanfold.session.work_dir``) and read back.  That cuts lineage without
``localCheckpoint``: a lost executor costs the rerun of its own tasks only.
"""

from __future__ import annotations

import ctypes
import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanfold.session import ship_package, work_dir

FOLDER = "chanfold-llm"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared work folder."""
    return f"{work_dir(spark)}/{FOLDER}/{name}-{uuid.uuid4().hex}"


def arrow_uri(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark finds it in, in
    the spelling of ``pyarrow.fs``."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    scheme, rest = str(fs.makeQualified(hpath).toString()).split(":", 1)
    if scheme == "file":
        return "file://" + rest.removeprefix("//")
    return {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for path in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        if f"/{FOLDER}/" in path:
            hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table; call it when no result that reads
    them is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/{FOLDER}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


#: Bytes of a batch of rows that goes to a Python task; a longer row is a batch
#: of its own.  It bounds what a batch takes in the JVM and in the task.
BATCH_BYTES = 4 << 20


def python_tasks(spark: SparkSession) -> None:
    """Make this package importable in Python workers on a cluster, and have
    rows sent to them in small batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def as_double_vectors(df: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector takes part: not null, not empty, every component
    finite and not all zero.  The vector becomes ``array<double>``."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    nonzero = F.exists(v, lambda x: x != 0.0)
    return (df.where(F.col(vector_col).isNotNull())
            .where(~bad & nonzero).withColumn(vector_col, v))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def csr_gather(offsets: np.ndarray, flat: np.ndarray, picks: np.ndarray):
    """Rows ``picks`` of a ragged table (``offsets``, ``flat``), concatenated,
    and the length of each."""
    starts = offsets[picks]
    lens = offsets[picks + 1] - starts
    total = int(lens.sum())
    if not total:
        return flat[:0], lens
    ends = np.cumsum(lens)
    at = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)
    return flat[at], lens


def batches(sizes, most: int):
    """Slices of consecutive items whose sizes sum to at most ``most`` (one
    larger item is a slice of its own)."""
    lo, total = 0, 0
    for i, s in enumerate(sizes):
        if i > lo and total + s > most:
            yield slice(lo, i)
            lo, total = i, 0
        total += s
    if lo < len(sizes):
        yield slice(lo, len(sizes))


def release() -> None:
    """Give memory that a Python task no longer needs back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass
