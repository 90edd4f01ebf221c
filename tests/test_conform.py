import pytest
from pyspark.sql import functions as F

from chanfold.operators import conform as conf
from chanfold.plans import raw_dialects
from chanfold.plans.layers import Layers
from chanfold.specs import CHANNEL_SPECS, FACT_COLUMNS, channel_for_source
from conftest import SF_SMALL, rows


def test_explode_keeps_empty_and_null_lists(spark):
    df = spark.createDataFrame(
        [("o1", [(1, "a")]), ("o2", []), ("o3", None)],
        "orderId string, lines array<struct<catCode: bigint, article: string>>")
    out = rows(conf.flatten_lines(df, "lines"))
    assert out == [("o1", 1, "a"), ("o2", None, None), ("o3", None, None)]


def test_rename_missing_column_is_an_error(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="missing"):
        conf.rename_strict(df, {"a": "x", "b": "y"})


def test_union_rejects_type_mismatch(spark):
    a = spark.createDataFrame([(1,)], "q bigint")
    b = spark.createDataFrame([(1.0,)], "q double")
    with pytest.raises(ValueError, match="differs"):
        conf.union_channels([a, b])


def test_unknown_source_is_an_error():
    assert channel_for_source("currency_reference") is None
    assert channel_for_source("retail_orders") == "retail"
    with pytest.raises(ValueError):
        channel_for_source("marketplace_orders")


@pytest.mark.parametrize("channel", sorted(CHANNEL_SPECS))
def test_conform_round_trip(spark, channel):
    fact = Layers(spark, SF_SMALL).fact()
    raw = raw_dialects.RAW_ENCODERS[channel](fact)
    got = conf.conform(raw, CHANNEL_SPECS[channel])
    want = fact.filter(F.col("channel") == channel)
    if channel == "app":     # unit price is recomputed from the amount
        want = want.withColumn("unit_price", F.when(F.col("qty_sold") > 0,
                                                    F.col("revenue_local") / F.col("qty_sold")))
    assert got.columns == FACT_COLUMNS
    assert got.exceptAll(want.select(*FACT_COLUMNS)).count() == 0
    assert want.select(*FACT_COLUMNS).exceptAll(got).count() == 0


def test_explode_preserves_quantity(spark):
    fact = Layers(spark, SF_SMALL).fact()
    nested = raw_dialects.ecomm_raw(fact)
    flat = conf.flatten_lines(nested, "lines")
    want = fact.filter(F.col("channel") == "ecomm").agg(F.sum("qty_ordered")).first()[0]
    assert flat.agg(F.sum("qtyOrd")).first()[0] == want


def test_unmapped_values_pass_through(spark):
    raw = spark.createDataFrame(
        [("t1", "c1", "Atlantis", "2025-01", "Runing", "1", 1, 1, 2.0, "ARS", "Y", "WEIRD")],
        raw_dialects.RAW_SCHEMAS["retail"])
    r = conf.conform(raw, CHANNEL_SPECS["retail"]).first()
    assert (r["country"], r["category"], r["order_status"], r["member"]) == \
        ("Atlantis", "Running", "weird", True)


@pytest.mark.parametrize("same", [True, False])
def test_large_order_stays_one_record(spark, same):
    line = F.lit(1) if same else F.col("id")
    hot = spark.range(25_000).select(
        F.lit("ecomm").alias("channel"), F.lit("c").alias("consumer_id"), F.lit("HOT").alias("order_id"),
        F.lit("AR").alias("country"), F.lit("2000-01").alias("year_month"), F.lit("Running").alias("category"),
        line.cast("string").alias("product_id"), F.lit(1).cast("bigint").alias("qty_ordered"),
        F.lit(1).cast("bigint").alias("qty_sold"), F.lit(2.0).alias("unit_price"), F.lit("ARS").alias("currency"),
        F.lit(2.0).alias("revenue_local"), F.lit("delivered").alias("order_status"), F.lit(True).alias("member"))
    nested = raw_dialects.ecomm_raw(hot)
    assert [r[0] for r in nested.select(F.size("lines")).collect()] == [25_000]
    assert conf.flatten_lines(nested, "lines").count() == 25_000
