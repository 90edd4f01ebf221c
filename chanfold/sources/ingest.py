"""Bronze layer: ingest every discovered raw source to Parquet, unchanged
except for two provenance columns."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from chanfold.sources.readers import discover_sources, reader_for
from chanfold.sources.versions import current, replace_table


def ingestion_timestamp() -> str:
    """One UTC ISO-8601 value per ingestion run, taken on the driver, so every
    row and every re-evaluation of the plan carries the same value."""
    return datetime.now(timezone.utc).isoformat()


def add_provenance(df: DataFrame, source_file: str, ingested_at: str) -> DataFrame:
    """``_source`` = the source entry name with its extension;
    ``_ingested_at`` = the run's timestamp text."""
    return df.withColumns({"_source": F.lit(source_file), "_ingested_at": F.lit(ingested_at)})


# Provenance by part file: column -> field of the hidden ``_metadata`` column.
PART_COLUMNS = {"_part": "file_path", "_part_bytes": "file_size", "_part_modified": "file_modification_time"}


def _reader_with_parts(file_format: str, name: str = "?"):
    if file_format == ".xlsx":
        raise ValueError(f"rows of a workbook do not carry their part file (source: {name})")
    return reader_for(file_format, name)


def add_part_provenance(df: DataFrame) -> DataFrame:
    """A table straight from a file reader with the part file of every row, its
    size in bytes and its time of modification."""
    return df.select("*", *[F.col(f"_metadata.{field}").alias(c) for c, field in PART_COLUMNS.items()])


def part_files(spark: SparkSession, path: str, file_format: str, schema=None) -> DataFrame:
    """(_part, _part_bytes, _part_modified, n_rows): every part file of a source
    with the number of rows read from it, 0 included.

    The files come from a listing (no content is read), the rows from one
    aggregation of the source by file, combined before its shuffle, so a file
    that holds most rows costs no task more than its scan."""
    df = _reader_with_parts(file_format, path)(spark, path, schema)
    counts = df.groupBy(F.col("_metadata.file_path").alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))
    listed = add_part_provenance(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path))
    return (listed.select(*PART_COLUMNS).join(counts, F.col("_part") == F.col("part"), "left")
            .select(*PART_COLUMNS, F.coalesce("n_rows", F.lit(0)).alias("n_rows")))


def ingest_source(spark: SparkSession, path: str, name: str, file_format: str, bronze_dir: str,
                  schema=None, ingested_at: str | None = None, parts: bool = False) -> DataFrame:
    """Read one source, add provenance (with ``parts`` also the part file of each
    row), replace ``<bronze>/<name>.parquet`` and return the written table
    (re-read, so downstream plans start from the bronze files, not from the raw
    ones)."""
    if parts:
        df = add_part_provenance(_reader_with_parts(file_format, name)(spark, path, schema))
    else:
        df = reader_for(file_format, name)(spark, path, schema)
    entry = path.rstrip("/").rsplit("/", 1)[-1]
    df = add_provenance(df, entry, ingested_at or ingestion_timestamp())
    out = f"{bronze_dir.rstrip('/')}/{name}.parquet"
    return replace_table(df, out)


def catalog_rows(spark: SparkSession, raw_dir: str) -> list:
    """The catalog on the driver: one row of metadata per source (bounded by
    the number of sources, not by their size)."""
    from chanfold.session import path_exists
    if not path_exists(spark, raw_dir):
        raise FileNotFoundError(f"raw folder does not exist: {raw_dir}")
    rows = discover_sources(spark, raw_dir).collect()
    if not rows:
        raise FileNotFoundError(f"no supported sources found in {raw_dir}")
    seen = {}
    for r in rows:
        if r["name"] in seen:
            raise ValueError(f"two sources share the name {r['name']!r}: "
                             f"{seen[r['name']]} and {r['path']}")
        seen[r["name"]] = r["path"]
    return rows


def ingest_all(spark: SparkSession, raw_dir: str, bronze_dir: str,
               schemas: dict | None = None, parallelism: int = 4) -> dict[str, DataFrame]:
    """Discover and ingest every source (one Spark job per source); the
    result is keyed by source name.  ``schemas`` maps a source name to its
    declared schema; sources without one are read with inference.

    The per-source jobs are independent, so up to ``parallelism`` of them are
    submitted at once from driver threads: small sources then share the
    cluster instead of waiting for each other.  The first failure is raised."""
    from concurrent.futures import ThreadPoolExecutor

    schemas = schemas or {}
    run_ts = ingestion_timestamp()
    rows = catalog_rows(spark, raw_dir)

    def one(r):
        return r["name"], ingest_source(spark, r["path"], r["name"], r["format"], bronze_dir,
                                        schemas.get(r["name"]), run_ts)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(rows)))) as pool:
        results = list(pool.map(one, rows))
    return dict(results)


def load_layer(spark: SparkSession, layer_dir: str) -> dict[str, DataFrame]:
    """Every Parquet table of a layer folder (bronze, silver or gold), keyed by
    name without ``.parquet``: the current version of a table that has versions,
    else the folder or file itself.  Entries that start with ``_`` or ``.`` and files
    of other kinds are left out."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(layer_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"layer folder does not exist: {layer_dir}")
    out = {}
    for entry in fs.listStatus(path):
        name = entry.getPath().getName()
        if not name.startswith(("_", ".")) and (entry.isDirectory() or name.endswith(".parquet")):
            found = entry.getPath().toString()
            out[name.removesuffix(".parquet")] = spark.read.parquet(current(spark, found) or found)
    if not out:
        raise FileNotFoundError(f"no tables found in {layer_dir}")
    return out


def bronze_summary(frames: dict[str, DataFrame]) -> DataFrame:
    """(source, n_rows, n_columns) per ingested source, as one plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("source"), "n_rows",
                       F.lit(len(df.columns)).alias("n_columns"))
             for name, df in sorted(frames.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
