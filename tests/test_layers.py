import os

import pytest
from pyspark.sql import functions as F

from chanfold.plans.layers import Layers, file_fingerprint, materialize
from chanfold.session import work_dir
from conftest import SF_SMALL


def _entries(spark, prefix):
    base = f"{work_dir(spark)}/chanfold-layers".replace("file:", "")
    return sorted(d for d in os.listdir(base) if d.startswith(prefix)) if os.path.isdir(base) else []


def test_failed_write_leaves_no_table(spark):
    import uuid
    fp = uuid.uuid4().hex[:8]
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("boom")))
                                 .otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        materialize(spark, bad, "atomic_test", fp)
    assert _entries(spark, f"atomic_test-{fp}") == []
    good = materialize(spark, spark.range(10), "atomic_test", fp)
    assert good.count() == 10
    # written once: a second call reuses the table without running the plan
    assert materialize(spark, lambda: pytest.fail("must not rebuild"), "atomic_test", fp).count() == 10
    assert len(_entries(spark, f"atomic_test-{fp}")) == 2      # the pointer and the folder it names


def test_half_written_folder_is_never_served(spark):
    import uuid

    from chanfold.plans.layers import published
    base, key = f"{work_dir(spark)}/chanfold-half", uuid.uuid4().hex[:8]
    # What a crash may leave: a folder of that key without a pointer, and a
    # pointer to a folder that is gone.
    spark.range(2).write.parquet(f"{base}/{key}-0000")
    write = lambda folder: spark.range(10).write.parquet(folder)
    first = published(spark, base, key, write)
    assert spark.read.parquet(first).count() == 10
    assert published(spark, base, key, lambda f: pytest.fail("must not rebuild")) == first
    with open(f"{base}/{key}x.path".replace("file:", ""), "w") as f:
        f.write(f"{key}-gone")
    assert spark.read.parquet(published(spark, base, f"{key}x", write)).count() == 10


def test_changed_dictionary_changes_the_fingerprint(spark, monkeypatch):
    from chanfold import specs
    from chanfold.plans import layers as lay
    from chanfold.plans import raw_files
    layers = Layers(spark, SF_SMALL)
    before = raw_files._fingerprint(layers)
    assert before == raw_files._fingerprint(layers)
    monkeypatch.setitem(lay._SOURCE_HASH, id(specs), b"another text of the module")
    assert raw_files._fingerprint(layers) != before


def test_no_local_folder_off_local_masters(spark, monkeypatch):
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Cluster)


def test_bronze_is_written_once_per_snapshot(spark):
    from chanfold.plans import raw_files, registry
    registry.QUERIES["bronze_summary"](spark, SF_SMALL).collect()
    base = f"{work_dir(spark)}/chanfold-bronze".replace("file:", "")
    before = sorted(os.listdir(base))
    for key in ("gold_from_files", "gold_from_files", "bronze_provenance", "bronze_ingest"):
        registry.QUERIES[key](spark, SF_SMALL).collect()
    assert sorted(os.listdir(base)) == before
    assert raw_files.bronze_folder(Layers(spark, SF_SMALL)).startswith(work_dir(spark))


def test_fingerprint_tracks_file_metadata(spark, tmpdir_path):
    spark.range(5).write.parquet(f"{tmpdir_path}/t.parquet")
    a = file_fingerprint(spark, [f"{tmpdir_path}/t.parquet"])
    assert a == file_fingerprint(spark, [f"{tmpdir_path}/t.parquet"])
    spark.range(6).write.mode("overwrite").parquet(f"{tmpdir_path}/t.parquet")
    assert a != file_fingerprint(spark, [f"{tmpdir_path}/t.parquet"])


def test_silver_equals_lazy_derivation(spark):
    layers = Layers(spark, SF_SMALL)
    written, lazy = layers.fact_eur(), layers.fact_eur_lazy()
    assert written.columns == lazy.columns
    assert written.exceptAll(lazy).count() == 0 and lazy.exceptAll(written).count() == 0


def test_shuffles_start_with_partitions_by_input(spark):
    from chanfold import session
    key = session._INITIAL
    assert spark.conf.get(key, None) is None
    session.size_shuffles(spark, 1 << 20)
    assert spark.conf.get(key, None) is None
    session.size_shuffles(spark, 1000 * session.INPUT_PER_PARTITION)
    assert spark.conf.get(key) == "1000"
    session.size_shuffles(spark, 1 << 20)
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "33")                       # the owner's own number
    session.size_shuffles(spark, 1000 * session.INPUT_PER_PARTITION)
    assert spark.conf.get(key) == "33"
    spark.conf.unset(key)
