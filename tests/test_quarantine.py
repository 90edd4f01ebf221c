"""Rule results by row, and provenance by part file."""
import contextlib

import pytest
from pyspark.sql import functions as F

from chanfold.operators import fx, quality, quarantine
from chanfold.plans import registry
from chanfold.plans.layers import Layers
from chanfold.sources import ingest
from conftest import SF_SMALL, rows

SCHEMA = "id int, a int, b string"
RULES = ["a_negative", "b_missing", "a_equals_id"]
DATA = [(1, 1, "x"), (2, -5, None), (3, 7, "y"), (3, 7, "y"), (-4, -4, None), (5, None, ""), (None, None, None)]


def _rules():
    return dict(zip(RULES, [F.col("a") < 0, F.col("b").isNull(), F.col("a") == F.col("id")]))


def _failed(r):
    return [n for n, bad in (("a_negative", r[1] is not None and r[1] < 0), ("b_missing", r[2] is None),
                             ("a_equals_id", None not in r[:2] and r[0] == r[1])) if bad]


def test_every_row_lands_in_one_part_with_its_rules(spark, tmpdir_path):
    df = spark.createDataFrame(DATA, SCHEMA).repartition(3)
    quarantine.write_split(df, _rules(), f"{tmpdir_path}/s")
    good, bad, counts = quarantine.read_split(spark, f"{tmpdir_path}/s", SCHEMA)
    assert rows(good) == sorted((r for r in DATA if not _failed(r)), key=repr)
    named = bad.withColumn("failed", quarantine.failed_names(RULES))
    assert rows(named, "id", "a", "b", "failed") == sorted(((*r, _failed(r)) for r in DATA if _failed(r)), key=repr)
    assert dict(rows(counts)) == {n: sum(n in _failed(r) for r in DATA) for n in RULES}


def test_parts_are_read_apart_and_written_in_one_job(spark, tmpdir_path):
    quarantine.write_split(spark.createDataFrame(DATA, SCHEMA), _rules(), f"{tmpdir_path}/s")
    good, bad, _ = quarantine.read_split(spark, f"{tmpdir_path}/s", SCHEMA)
    for part, name in ((good, "accepted"), (bad, "quarantined")):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and f"(verdict#" in plan and f"= {name})" in plan
        assert "DataFilters: []" in plan


def test_empty_table_and_clashing_names(spark, tmpdir_path):
    quarantine.write_split(spark.createDataFrame([], SCHEMA), _rules(), f"{tmpdir_path}/s")
    good, bad, counts = quarantine.read_split(spark, f"{tmpdir_path}/s", SCHEMA)
    assert good.count() == bad.count() == 0 and dict(rows(counts)) == dict.fromkeys(RULES, 0)
    assert good.columns == ["id", "a", "b"] and bad.columns == ["id", "a", "b", "failed_mask"]
    with pytest.raises(ValueError, match="verdict"):
        quarantine.mark_failures(spark.range(1).withColumn("verdict", F.lit(1)), _rules())
    with pytest.raises(ValueError, match="62"):
        quarantine.mark_failures(spark.range(1), {f"r{i}": F.lit(True) for i in range(63)})


def test_sixty_two_rules_keep_their_bits(spark):
    rules = {f"r{i}": F.col("id") == i for i in range(62)}
    got = quarantine.mark_failures(spark.range(62), rules).withColumn("names", quarantine.failed_names(rules))
    assert [(r["id"], r["failed_mask"], r["names"]) for r in got.orderBy("id").collect()] == [
        (i, 1 << i, [f"r{i}"]) for i in range(62)]


def test_row_rules_agree_with_the_counts(spark):
    faulty = registry._faulty_fact(Layers(spark, SF_SMALL).fact())
    rules = quality.fact_rules()
    marked = quarantine.mark_failures(faulty, rules).select(F.explode(quarantine.failed_names(rules)).alias("rule"))
    by_row = {r["rule"]: r["count"] for r in marked.groupBy("rule").count().collect()}
    want = {r["rule"]: r["violations"] for r in quality.validate_fact(faulty).collect()}
    assert by_row == {k: v for k, v in want.items() if v} and len(by_row) >= 8


def test_rate_rows(spark):
    rates = spark.createDataFrame(
        [("AR", "2025-01", "EUR", 2.0), ("AR", "2025-01", "EUR", 3.0), (None, "2025-01", "EUR", 1.0),
         (None, "2025-01", "EUR", 1.0), ("CL", "2025/02", "USD", None), ("CL", "2025-03", "EUR", 4.0)],
        "country string, year_month string, currency_to string, local_units_per_eur double")
    keyed = quarantine.with_key_rows(rates)
    assert keyed.count() == 6
    got = quarantine.mark_failures(keyed, quarantine.rate_rules()).withColumn(
        "failed", F.array_join(quarantine.failed_names(quarantine.rate_rules()), " "))
    assert sorted(r["failed"] for r in got.collect()) == sorted(
        ["duplicate_keys", "duplicate_keys", "duplicate_keys null_country", "duplicate_keys null_country",
         "non_positive_rate bad_month_format currency_to_not_eur", ""])
    want = {r["rule"]: r["violations"] for r in fx.validate_rates(rates).collect()}
    assert want["duplicate_keys"] == 2 and set(want) == set(quarantine.rate_rules())


def test_part_files_by_row_and_by_file(spark, tmpdir_path):
    import os
    path = f"{tmpdir_path}/a b.csv"
    os.makedirs(path)
    sizes = {"part 1.csv": 3, "part-2.csv": 1, "part-3.csv": 0}
    for name, n in sizes.items():
        with open(f"{path}/{name}", "w") as f:
            f.write("\n".join(["x,y", *[f"{i},v" for i in range(n)]]) + "\n")
    got = ingest.part_files(spark, path, ".csv", "x int, y string").collect()
    decoded = {r["_part"].rsplit("/", 1)[1].replace("%20", " "): r for r in got}
    assert {k: r["n_rows"] for k, r in decoded.items()} == sizes
    assert all(r["_part_bytes"] == os.path.getsize(f"{path}/{k}") and r["_part_modified"] for k, r in decoded.items())
    out = ingest.ingest_source(spark, path, "s", ".csv", f"{tmpdir_path}/bronze", "x int, y string", parts=True)
    assert out.columns == ["x", "y", *ingest.PART_COLUMNS, "_source", "_ingested_at"]
    assert {r["_part"] for r in out.collect()} == {r["_part"] for r in got if r["n_rows"]}
    with pytest.raises(ValueError, match="workbook"):
        ingest.part_files(spark, path, ".xlsx", "x int")


def test_split_writes_both_parts_without_a_sort(spark, tmp_path, monkeypatch):
    """The write sees two open folders a task; afterwards the setting is as before."""
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(key)
    real = quarantine.open_folders

    @contextlib.contextmanager
    def watched(session, n):
        with real(session, n):
            seen.append(session.conf.get(key))
            yield

    monkeypatch.setattr(quarantine, "open_folders", watched)
    quarantine.write_split(spark.range(100), {"odd": F.col("id") % 2 == 1}, f"{tmp_path}/s")
    assert seen == ["2"] and spark.conf.get(key) == before
    ok, bad, rules = quarantine.read_split(spark, f"{tmp_path}/s", "id bigint")
    assert ok.count() == bad.count() == 50 and rules.collect()[0]["violations"] == 50
