"""Loyalty-member comparisons and the what-if uplift."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chanfold.functions.arith import ieee_divide, money_sum_or_zero, n_unique, zero_if_null
from chanfold.specs import REAL_SALE_STATUSES


def _real_known(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("member").isNotNull()
                       & F.col("order_status").isin(*REAL_SALE_STATUSES))


def member_comparison(fact_eur: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Per member flag over real sales with a known flag: revenue, lines,
    distinct orders (on ``order_id`` alone; null counts once) and revenue
    per distinct order.  The distinct count is planned as a two-phase
    aggregate shuffled on (member, order_id), so the two-valued flag does
    not put all rows on one task."""
    agg = _real_known(fact_eur).groupBy("member").agg(
        money_sum_or_zero(zero_if_null(F.col("revenue_eur"))).alias("revenue_total"),
        F.count(F.lit(1)).alias("num_lineas"),
        n_unique(F.col("order_id"), approx=approx_distinct).alias("num_ordenes_unicas"),
    )
    return agg.withColumn("avg_revenue_por_orden",
                          ieee_divide(F.col("revenue_total"), F.col("num_ordenes_unicas")))


def member_orders_by_channel(fact_eur: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Distinct orders per (channel, member flag) over real sales."""
    return (_real_known(fact_eur).groupBy("channel", "member")
            .agg(n_unique(F.col("order_id"), approx=approx_distinct).alias("num_ordenes"))
            .orderBy("channel", "member"))


def orders_by_member(fact_eur: DataFrame) -> DataFrame:
    """Distinct orders per member flag over all real sales, the unknown flag
    included as its own group (where order ids may be null)."""
    return (fact_eur.filter(F.col("order_status").isin(*REAL_SALE_STATUSES))
            .groupBy("member")
            .agg(n_unique(F.col("order_id")).alias("num_ordenes"),
                 F.count(F.lit(1)).alias("num_lineas")))


def member_uplift(comparison: DataFrame, share: float = 0.10) -> DataFrame:
    """What-if: if ``share`` of the non-member base ordered as often as
    members do, how many orders and how much revenue would that add.

    ratio = member orders / non-member orders;
    new orders = non-member orders x share x (ratio - 1);
    revenue = new orders x member average ticket.
    Works on the two-row comparison table (no driver round trip)."""
    m = F.col("member")
    one = comparison.agg(
        F.max(F.when(m, F.col("num_ordenes_unicas"))).alias("member_orders"),
        F.max(F.when(~m, F.col("num_ordenes_unicas"))).alias("non_member_orders"),
        F.max(F.when(m, F.col("avg_revenue_por_orden"))).alias("member_avg_ticket"),
    )
    ratio = ieee_divide(F.col("member_orders"), F.col("non_member_orders"))
    new_orders = F.col("non_member_orders") * F.lit(float(share)) * (F.col("uplift_ratio") - 1)
    return (one.withColumn("share", F.lit(float(share)))
               .withColumn("uplift_ratio", ratio)
               .withColumn("potential_new_orders", new_orders)
               .withColumn("potential_revenue", F.col("potential_new_orders") * F.col("member_avg_ticket")))
