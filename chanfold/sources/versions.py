"""Tables that are replaced as a whole: ``<path>/v-<id>/`` holds one version, the
file ``<path>/_current`` names the one that counts and the one before it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, ref = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(ref):
        return []
    stream = fs.open(ref)
    try:
        return bytes(stream.readNBytes(4096)).decode().split()
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that counts, or None if ``path`` is no such table."""
    path = path.rstrip("/")
    names = _names(spark, path)
    return f"{path}/{names[0]}" if names else None


def _point(spark: SparkSession, path: str, names: list[str]) -> None:
    """Replace the pointer in one step: readers see the old or the new one."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    fs, draft = _fs(spark, f"{path}/_{names[0]}.draft")
    out = fs.create(draft, True)
    out.write(bytearray("\n".join(names).encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(draft), fs.makeQualified(_fs(spark, f"{path}/{POINTER}")[1]), how)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as the new version of the Parquet table ``path`` and read it
    back.

    The version becomes visible only when it is whole, so a failed or lost write
    leaves the table as it was, and ``df`` may read the table it replaces.  The
    version before stays for plans that still read it; the one before that is
    deleted.  Of writers at the same time the last counts."""
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"v-{uuid.uuid4().hex}"
    folder = f"{path}/{name}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    try:
        writer.parquet(folder)
    except Exception:
        fs, part = _fs(spark, folder)
        fs.delete(part, True)
        raise
    before = _names(spark, path)
    _point(spark, path, [name, *before[:1]])
    for gone in before[1:]:
        fs, part = _fs(spark, f"{path}/{gone}")
        fs.delete(part, True)
    return spark.read.parquet(folder)
