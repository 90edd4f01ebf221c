import pytest
from pyspark.sql import Observation

from chanfold.operators import fx

FACT = ("channel string, country string, year_month string, currency string, "
        "revenue_local double, unit_price double")
RATES = "country string, year_month string, currency_to string, local_units_per_eur double"


def _data(spark):
    fact = spark.createDataFrame([
        ("retail", "AR", "2025-01", "ARS", 100.0, 10.0),
        ("retail", "AR", "2025-02", "ARS", 100.0, 10.0),     # no rate -> null, audited
        ("ecomm", "AR", "2025-02", "EUR", 50.0, 5.0),        # EUR stays
        ("app", "AR", "2025-01", None, 100.0, 10.0),         # null currency: converted, not audited
        ("app", "BR", "2025-01", "BRL", 100.0, 10.0),        # zero rate -> null
    ], FACT)
    rates = spark.createDataFrame([("AR", "2025-01", "EUR", 4.0), ("BR", "2025-01", "EUR", 0.0)], RATES)
    return fact, rates


@pytest.mark.parametrize("broadcast", [True, False])
def test_conversion_rules(spark, broadcast):
    fact, rates = _data(spark)
    out = [(r["channel"], r["year_month"], r["revenue_eur"], r["unit_price_eur"])
           for r in fx.convert_to_eur(fact, rates, broadcast=broadcast).collect()]
    assert sorted(out, key=repr) == sorted([
        ("retail", "2025-01", 25.0, 2.5), ("retail", "2025-02", None, None),
        ("ecomm", "2025-02", 50.0, 5.0), ("app", "2025-01", 25.0, 2.5),
        ("app", "2025-01", None, None)], key=repr)


def test_missing_rate_audit_and_observation(spark):
    fact, rates = _data(spark)
    audit = [tuple(r) for r in fx.missing_rates(fact, rates).collect()]
    assert audit == [("retail", "AR", "2025-02", 1)]
    obs = Observation("fx")
    fx.convert_to_eur(fact, rates, observation=obs).collect()
    assert obs.get["missing_rate_rows"] == 1


def test_rate_validation_finds_planted_faults(spark):
    rates = spark.createDataFrame([
        ("AR", "2025-01", "EUR", 4.0), ("AR", "2025-01", "EUR", 4.1),     # duplicate key
        ("BR", "2025-1", "EUR", 0.0), (None, "2025-01", "USD", 2.0)], RATES)
    out = {r["rule"]: r["violations"] for r in fx.validate_rates(rates).collect()}
    assert out == {"duplicate_keys": 1, "non_positive_rate": 1, "bad_month_format": 1,
                   "null_country": 1, "currency_to_not_eur": 1}


def test_rate_one_is_identity(spark):
    fact = spark.createDataFrame([("retail", "AR", "2025-01", "ARS", 7.5, 1.5)], FACT)
    rates = spark.createDataFrame([("AR", "2025-01", "EUR", 1.0)], RATES)
    r = fx.convert_to_eur(fact, rates).first()
    assert r["revenue_eur"] == 7.5 and r["unit_price_eur"] == 1.5


def test_broadcast_check(spark):
    rates = spark.createDataFrame([("AR", f"2025-0{i}", "EUR", 1.0) for i in range(1, 6)], RATES)
    assert fx.rates_fit_broadcast(rates, max_rows=5)
    assert not fx.rates_fit_broadcast(rates, max_rows=4)


@pytest.mark.parametrize("broadcast", [True, False])
def test_duplicate_rates_raise(spark, broadcast):
    fact, rates = _data(spark)
    twice = rates.union(spark.createDataFrame([("AR", "2025-01", "EUR", 5.0)], RATES))
    with pytest.raises(fx.DuplicateRates, match="2 rates for AR, 2025-01"):
        fx.convert_to_eur(fact, twice, broadcast=broadcast)


def test_shuffle_join_deals_a_hot_month_over_slices(spark):
    from pyspark.sql import functions as F

    from chanfold.operators import kpis
    _, rates = _data(spark)
    hot = spark.range(5000).select(
        F.lit("retail").alias("channel"), F.lit("AR").alias("country"), F.lit("2025-01").alias("year_month"),
        F.lit("ARS").alias("currency"), F.col("id").cast("double").alias("revenue_local"), F.lit(1.0).alias("unit_price"),
        F.lit("delivered").alias("order_status"), F.lit(1).cast("bigint").alias("qty_sold"),
        F.lit(1).cast("bigint").alias("qty_ordered"))
    eur = fx.convert_to_eur(hot, rates, broadcast=False)
    table = kpis.build_kpi_table(eur, fx.RATE_KEYS, sort=False)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "_salt" in plan
    # The aggregate has an exchange of its own, so slices stay apart in the join.
    import re
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert any("_salt" not in k for k in keys) and any("_salt" in k for k in keys)
    r = table.first()
    assert r["revenue_bruto_eur"] == sum(range(5000)) / 4.0
    slices = fx.join_rates(hot.withColumn("k", F.col("revenue_local")), rates, broadcast=False)
    assert slices.count() == 5000
