"""Tables replaced as a whole: a failed write leaves the old version readable."""
import os

import pytest
from pyspark.sql import functions as F

from chanfold.plans import medallion
from chanfold.sources import ingest, versions
from conftest import rows


def _folders(path):
    return sorted(f for f in os.listdir(path) if f.startswith("v-"))


def test_failed_rewrite_leaves_the_old_table(spark, tmpdir_path):
    path = f"{tmpdir_path}/layer/t"
    assert versions.current(spark, path) is None
    old = medallion.write_parquet(spark.range(5), path)
    bad = spark.range(1000).repartition(4).select(
        F.when(F.col("id") == 777, F.raise_error(F.lit("planted"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="planted"):
        medallion.write_parquet(bad, path)
    assert rows(ingest.load_layer(spark, f"{tmpdir_path}/layer")["t"]) == rows(old) == [(i,) for i in range(5)]
    assert len(_folders(path)) == 1 and not [f for f in os.listdir(path) if f.endswith(".draft")]


def test_versions_follow_each_other(spark, tmpdir_path):
    path = f"{tmpdir_path}/layer/t.parquet"
    first = versions.replace_table(spark.range(3), path)
    kept = _folders(path)
    second = versions.replace_table(first.select((F.col("id") + 10).alias("id")), path + "/")   # reads what it replaces
    assert rows(first) == [(0,), (1,), (2,)] and rows(second) == [(10,), (11,), (12,)]
    third = versions.replace_table(second.withColumn("p", F.col("id") % 2), path, ["p"])
    assert not set(kept) & set(_folders(path)) and len(_folders(path)) == 2
    got = ingest.load_layer(spark, f"{tmpdir_path}/layer")["t"]
    assert rows(got, "id", "p") == rows(third, "id", "p") == [(10, 0), (11, 1), (12, 0)]
    assert rows(second) == [(10,), (11,), (12,)]


def test_a_version_without_pointer_does_not_count(spark, tmpdir_path):
    path = f"{tmpdir_path}/layer/t"
    versions.replace_table(spark.range(2), path)
    spark.range(9).write.parquet(f"{path}/v-unfinished")                 # a writer that was lost
    assert ingest.load_layer(spark, f"{tmpdir_path}/layer")["t"].count() == 2
    versions.replace_table(spark.range(4), path)
    assert ingest.load_layer(spark, f"{tmpdir_path}/layer")["t"].count() == 4
