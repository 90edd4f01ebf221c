"""Data-quality checks on the conformed fact: rule tables, the null-revenue
diagnosis and the cross-channel sanity check after conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chanfold.functions.arith import ieee_divide, money_sum
from chanfold.specs import (CATEGORY_FIX, CHANNEL_SPECS, COUNTRY_NAME_TO_ISO2, FRANCHISE_STATUS_MAP)

ALLOWED_COUNTRIES = sorted(set(COUNTRY_NAME_TO_ISO2.values()))
ALLOWED_CATEGORIES = sorted(set(CATEGORY_FIX.values()))
ALLOWED_STATUSES = sorted(set(FRANCHISE_STATUS_MAP.values()))
ALLOWED_CHANNELS = sorted(CHANNEL_SPECS)
MONTH_PATTERN = r"^[0-9]{4}-[0-9]{2}$"


def _not_in(c: str, allowed: list[str]) -> F.Column:
    return ~F.coalesce(F.col(c).isin(*allowed), F.lit(False))


def fact_rules() -> dict[str, F.Column]:
    """Rule name -> predicate that marks a violating row."""
    sold, ordered = F.col("qty_sold"), F.col("qty_ordered")
    ch = F.col("channel")
    return {
        "country_not_allowed": _not_in("country", ALLOWED_COUNTRIES),
        "category_not_allowed": _not_in("category", ALLOWED_CATEGORIES),
        "status_not_allowed": _not_in("order_status", ALLOWED_STATUSES),
        "channel_not_allowed": _not_in("channel", ALLOWED_CHANNELS),
        "month_bad_format": ~F.coalesce(F.col("year_month").rlike(MONTH_PATTERN), F.lit(False)),
        "null_currency": F.col("currency").isNull(),
        "negative_quantity": F.coalesce((ordered < 0) | (sold < 0), F.lit(False)),
        "sold_exceeds_ordered": F.coalesce(sold > ordered, F.lit(False)),
        "wholesale_null_revenue_with_sales": F.coalesce(
            (ch == "wholesale") & F.col("revenue_local").isNull() & (sold != 0), F.lit(False)),
        "app_amount_without_sales": F.coalesce(
            (ch == "app") & (sold == 0) & (F.col("revenue_local") != 0), F.lit(False)),
    }


def validate_fact(fact: DataFrame) -> DataFrame:
    """(rule, violations) for all rules in one aggregation pass."""
    rules = fact_rules()
    wide = fact.agg(*[F.count_if(pred).alias(name) for name, pred in rules.items()])
    return wide.unpivot([], list(rules), "rule", "violations")


def null_revenue_diagnosis(fact: DataFrame) -> DataFrame:
    """Wholesale rows with null revenue, by status, with which input is null
    and how many have zero units sold (expected: all of them)."""
    w = fact.filter((F.col("channel") == "wholesale") & F.col("revenue_local").isNull())
    return w.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("qty_sold").isNull()).alias("null_qty_sold"),
        F.count_if(F.col("unit_price").isNull()).alias("null_unit_price"),
        F.count_if(F.col("qty_ordered").isNull()).alias("null_qty_ordered"),
        F.count_if(F.col("qty_sold") == 0).alias("zero_qty_sold"),
    )


def avg_revenue_by_channel(fact_eur: DataFrame) -> DataFrame:
    """Mean EUR line revenue and null count per channel (sanity check that
    all channels are in one unit after conversion)."""
    return fact_eur.groupBy("channel").agg(
        ieee_divide(money_sum("revenue_eur"), F.count("revenue_eur")).alias("avg_revenue_eur"),
        F.count_if(F.col("revenue_eur").isNull()).alias("nulls"),
    )
