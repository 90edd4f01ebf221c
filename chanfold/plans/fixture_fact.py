"""Sales fact and rate table derived from the driver's star-schema tables.

The order files of the source system are not available, so the fact table is
derived deterministically from ``lineitem``, ``orders``, ``customer`` and
``part`` (one fact row per line item); see FIXTURES.md section 4.  The same
derivation is written in SQL in ``chanfold.plans.oracle`` for the DuckDB
check.

Scale notes: the derivation is two big equi-joins (line items to orders on
the order key, to parts on the part key) plus a customer join.  Nothing is
hinted: Spark broadcasts a dimension only while its file-size estimate is
under ``spark.sql.autoBroadcastJoinThreshold`` and uses sort-merge joins
(with AQE skew splitting) beyond it.  Columns are pruned at the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chanfold.functions.recode import literal_map
from chanfold.specs import FACT_COLUMNS

# ---------------------------------------------------------------------------
# Fixed values of the derivation (FIXTURES.md section 4).
# ---------------------------------------------------------------------------
COUNTRIES = ["AR", "BR", "CL", "CO", "MX", "PE"]          # c_nationkey mod 6
LOCAL_CURRENCY = {"AR": "ARS", "BR": "BRL", "CL": "CLP", "CO": "COP", "MX": "MXN", "PE": "PEN"}
CATEGORIES = ["Running", "Outdoor", "Football", "Originals"]   # p_size mod 4
CHANNEL_BY_PRIORITY = {"1": "retail", "2": "ecomm", "3": "app", "4": "wholesale", "5": "franchise"}
EUR_CHANNELS = ["ecomm", "wholesale"]
# Rates left out on purpose so that the missing-rate audit has work to do.
MISSING_RATE_COUNTRY, MISSING_RATE_YEAR = "PE", "2001"
# End of fixed values.
# ---------------------------------------------------------------------------


def _orders_with_country(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """orders ⋈ customer, reduced to the columns the fact and the rate table
    need.  Shared by both so the same exchange can be reused."""
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = customer.select("c_custkey", "c_nationkey")
    return (od.join(cu, od.o_custkey == cu.c_custkey, "inner")
              .select("o_orderkey", "c_custkey", "o_orderdate", "o_orderpriority",
                      (F.col("c_nationkey") % 6).alias("country_idx"),
                      F.date_format("o_orderdate", "yyyy-MM").alias("year_month")))


def _country_of(idx_col) -> F.Column:
    return F.try_element_at(F.array(*[F.lit(c) for c in COUNTRIES]), idx_col + 1)


def derive_fact(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                part: DataFrame) -> DataFrame:
    """Canonical 14-column fact table (before currency conversion)."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                         "l_extendedprice", "l_returnflag", "l_linestatus")
    oc = _orders_with_country(orders, customer)
    pa = part.select("p_partkey", "p_size")
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey, "inner")
           .join(pa, li.l_partkey == pa.p_partkey, "inner"))

    channel = F.try_element_at(literal_map(CHANNEL_BY_PRIORITY), F.substring("o_orderpriority", 1, 1))
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    status = (F.when(rf == "R", "returned")
               .when(rf == "A", "delivered")
               .when((rf == "N") & (ls == "O"), "processing")
               .when((rf == "N") & (ls == "F"), "cancelled"))
    qty_ordered = F.col("l_quantity").cast("bigint")
    country = _country_of(F.col("country_idx"))
    custkey = F.col("c_custkey")

    stage1 = j.select(
        channel.alias("channel"),
        custkey.alias("_custkey"),
        F.col("o_orderkey").alias("_orderkey"),
        country.alias("country"),
        F.col("year_month"),
        F.try_element_at(F.array(*[F.lit(c) for c in CATEGORIES]),
                         F.col("p_size") % 4 + 1).alias("category"),
        F.col("p_partkey").cast("string").alias("product_id"),
        qty_ordered.alias("qty_ordered"),
        status.alias("order_status"),
        F.col("l_linenumber").alias("_linenumber"),
        F.when(F.col("l_quantity") != 0,
               F.col("l_extendedprice") / F.col("l_quantity")).alias("_price"),
    )
    ch = F.col("channel")
    qty_sold = (F.when(F.col("order_status").isin("processing", "cancelled"), F.lit(0).cast("bigint"))
                 .otherwise(F.greatest(F.lit(0).cast("bigint"),
                                       F.col("qty_ordered") - F.col("_linenumber") % 3)))
    stage2 = stage1.withColumn("qty_sold", qty_sold)
    sold, price = F.col("qty_sold"), F.col("_price")
    keyed = ch != "wholesale"
    return stage2.select(
        ch.alias("channel"),
        F.when(keyed, F.col("_custkey").cast("string")).alias("consumer_id"),
        F.when(keyed, F.col("_orderkey").cast("string")).alias("order_id"),
        "country", "year_month", "category", "product_id", "qty_ordered", "qty_sold",
        F.when(ch.isin("wholesale", "app") & (sold == 0), F.lit(None).cast("double"))
         .otherwise(price).alias("unit_price"),
        F.when(ch.isin(*EUR_CHANNELS), F.lit("EUR"))
         .otherwise(F.try_element_at(literal_map(LOCAL_CURRENCY), F.col("country"))).alias("currency"),
        F.when((ch == "wholesale") & (sold == 0), F.lit(None).cast("double"))
         .otherwise(sold * price).alias("revenue_local"),
        "order_status",
        F.when(ch == "wholesale", F.lit(None).cast("boolean"))
         .when((ch == "app") & (F.col("_custkey") % 3 == 0), F.lit(None).cast("boolean"))
         .when((ch == "retail") & (F.col("_custkey") % 50 == 0), F.lit(None).cast("boolean"))
         .otherwise(F.col("_custkey") % 3 != 0).alias("member"),
    ).select(*FACT_COLUMNS)


def derive_rates(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Monthly rate table, one row per (country, year_month) that occurs in
    the orders, rate = (country index + 1) * 10 + month number * 0.25; one
    country-year is left out.  Output is bounded by countries x months, not
    by the data volume; the distinct is partially aggregated map-side."""
    keys = (_orders_with_country(orders, customer)
            .select("country_idx", "year_month").distinct())
    month_no = F.substring("year_month", 6, 2).cast("int")
    rate = ((F.col("country_idx") + 1) * 10 + month_no * F.lit(0.25)).cast("double")
    out = keys.select(
        _country_of(F.col("country_idx")).alias("country"),
        "year_month",
        F.try_element_at(literal_map(LOCAL_CURRENCY),
                         _country_of(F.col("country_idx"))).alias("currency_from"),
        F.lit("EUR").alias("currency_to"),
        rate.alias("local_units_per_eur"),
    )
    return out.filter(~((F.col("country") == MISSING_RATE_COUNTRY)
                        & F.col("year_month").startswith(MISSING_RATE_YEAR)))
