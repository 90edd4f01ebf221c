"""Loyalty tables from a cube: additive sums and exact distinct orders.

A distinct count does not add up over cells.  So each cell (channel, member
flag) keeps, beside its sums, the set of its orders as bitmaps over dense order
numbers: one row per 32,768 numbers, 4 KB each.  Bitmaps of several cells are
merged by OR, so any cut counts each order once, and no query reads the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chanfold.functions.arith import MONEY_PARTS, ieee_divide, money_total
from chanfold.operators.kpis import PARTIAL_COLS, _is_real, kpi_partials

CELL = ["channel", "member"]


def placed_orders(fact: DataFrame) -> DataFrame:
    """(order_id, place): every order id that is not null once, with a number
    that leaves gaps between tasks.  It must be written before it is read."""
    return (fact.where(F.col("order_id").isNotNull()).select("order_id").distinct()
            .withColumn("place", F.monotonically_increasing_id()))


def order_numbers(placed: DataFrame) -> DataFrame:
    """(order_id, order_no) from a written ``placed_orders``: numbers from 1
    without gaps.  One count per task of that write reaches the driver."""
    task = F.shiftright("place", 33)
    bases, start = [], 1
    for t, n in sorted(map(tuple, placed.groupBy(task).count().collect())):
        bases.append((t, start - (t << 33)))
        start += n
    base = placed.sparkSession.createDataFrame(bases, "task bigint, base bigint")
    return placed.join(F.broadcast(base), task == F.col("task")).select(
        "order_id", (F.col("place") + F.col("base")).alias("order_no"))


def cell_sums(fact_eur: DataFrame) -> DataFrame:
    """Additive KPI inputs of each cell and ``null_orders``, the number of real
    sales without an order id."""
    nulls = fact_eur.where(_is_real()).groupBy(*CELL).agg(F.count_if(F.col("order_id").isNull()).alias("null_orders"))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"n.{c}")) for c in CELL]
    sums = kpi_partials(fact_eur, CELL).where("n_real > 0")
    return sums.alias("s").join(nulls.alias("n"), same).select("s.*", "null_orders")


def cell_orders(fact_eur: DataFrame, numbers: DataFrame) -> DataFrame:
    """(cell, bucket, orders): bitmaps of the orders with real sales."""
    pairs = fact_eur.where(_is_real()).select(*CELL, "order_id").distinct().join(numbers, "order_id")
    return (pairs.groupBy(*CELL, F.bitmap_bucket_number("order_no").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("order_no")).alias("orders")))


def orders_of(orders: DataFrame, by: list[str]) -> DataFrame:
    """(by, n_orders): distinct orders of a cut, by merging its bitmaps."""
    merged = orders.groupBy(*by, "bucket").agg(F.bitmap_or_agg("orders").alias("orders"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("orders")).alias("n_orders"))


def _cut(sums: DataFrame, orders: DataFrame, by: list[str]) -> DataFrame:
    """Sums of a cut with ``num_ordenes``, null order ids counting as one more."""
    own = sums.groupBy(*by).agg(*(F.sum(c).alias(c) for c in [*PARTIAL_COLS, "null_orders"]))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}")) for c in by]
    counted = own.alias("s").join(orders_of(orders, by).alias("o"), same, "left")
    return counted.select("s.*", (F.coalesce("n_orders", F.lit(0))
                                  + F.when(F.col("null_orders") > 0, 1).otherwise(0)).alias("num_ordenes"))


def member_comparison(sums: DataFrame, orders: DataFrame) -> DataFrame:
    """Same columns as ``loyalty.member_comparison``."""
    revenue = money_total({part: F.col(f"{part}_real") for part in MONEY_PARTS})
    out = _cut(sums.where("member IS NOT NULL"), orders, ["member"]).select(
        "member", F.coalesce(revenue, F.lit(0.0)).alias("revenue_total"), F.col("n_real").alias("num_lineas"),
        F.col("num_ordenes").cast("bigint").alias("num_ordenes_unicas"))
    return out.withColumn("avg_revenue_por_orden", ieee_divide(F.col("revenue_total"), F.col("num_ordenes_unicas")))


def member_orders_by_channel(sums: DataFrame, orders: DataFrame) -> DataFrame:
    """Same columns as ``loyalty.member_orders_by_channel``."""
    return (_cut(sums.where("member IS NOT NULL"), orders, CELL)
            .select(*CELL, F.col("num_ordenes").cast("bigint").alias("num_ordenes")).orderBy(*CELL))


def orders_by_member(sums: DataFrame, orders: DataFrame) -> DataFrame:
    """Same columns as ``loyalty.orders_by_member``."""
    return _cut(sums, orders, ["member"]).select(
        "member", F.col("num_ordenes").cast("bigint").alias("num_ordenes"), F.col("n_real").alias("num_lineas"))
