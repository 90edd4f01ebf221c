"""Versioned KPIs over any grouping: gross revenue, return rate, fulfillment.

Design: every KPI input is additive, so the three KPIs of a cut are computed
in ONE aggregation (five conditional sums and a count), instead of three
aggregations and two joins.  Several cuts share one fine-grained partial
aggregate (the "cube") from which each cut is rolled up: the fact is scanned
and shuffled once, and the shuffle carries at most one row per cube cell per
map task thanks to partial aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from chanfold.functions.arith import (MONEY_PARTS, ieee_divide, money_parts, money_sum, money_sum_or_zero,
                                      money_total, nan_to_zero, zero_if_null)
from chanfold.specs import REAL_SALE_STATUSES


@dataclass(frozen=True)
class MetricDef:
    """One version of a KPI: its documented contract, and the formula over the
    additive inputs that every KPI table of the gold layer is made with.
    ``rate`` formulas are null where a grouping key is null (null keys never
    match in the per-KPI join formulation)."""

    name: str
    version: str
    numerator: str
    denominator: str
    zero_rule: str
    value: Callable[[], F.Column]
    rate: bool = True


def _revenue(name: str) -> F.Column:
    return F.coalesce(money_total({part: F.col(f"{part}_{name}") for part in MONEY_PARTS}), F.lit(0.0))


# Versioned metric definitions (the contract of the gold layer).
KPI_DEFINITIONS = [
    MetricDef("revenue_bruto_eur", "v1.0",
              "sum(revenue_eur, null as 0) where order_status in (delivered, returned)",
              "-", "no real sale: group absent",
              lambda: _revenue("real"), rate=False),
    MetricDef("return_rate", "v1.0",
              "sum(revenue_eur) where order_status = returned",
              "sum(revenue_eur) where order_status in (delivered, returned)",
              "0/0 -> 0",
              lambda: nan_to_zero(ieee_divide(_revenue("returned"), _revenue("delivered") + _revenue("returned")))),
    MetricDef("fulfillment_rate", "v1.0", "sum(qty_sold) over all statuses",
              "sum(qty_ordered) over all statuses", "0/0 -> NaN, x/0 -> inf",
              lambda: ieee_divide(F.col("qty_sold_total"), F.col("qty_ordered_total"))),
]


def _kpi_columns(null_key: F.Column) -> list[F.Column]:
    return [(F.when(null_key, F.lit(None).cast("double")).otherwise(m.value()) if m.rate else m.value())
            .alias(m.name) for m in KPI_DEFINITIONS]


CUBE_DIMS = ["country", "channel", "category", "year_month", "member"]
REVENUES = ["real", "delivered", "returned"]
PARTIAL_COLS = ["n_real", *[f"{part}_{r}" for r in REVENUES for part in MONEY_PARTS],
                "qty_sold_total", "qty_ordered_total"]


def kpi_versions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m.name, m.version, m.numerator, m.denominator, m.zero_rule)
                                  for m in KPI_DEFINITIONS],
                                 "metric string, version string, numerator string, "
                                 "denominator string, zero_rule string")


def _check_group_by(group_by: list[str]) -> list[str]:
    group_by = list(group_by)
    if "order_status" in group_by:
        raise ValueError("order_status cannot be a KPI grouping column: the return "
                         "rate splits by status itself")
    if len(set(group_by)) != len(group_by):
        raise ValueError(f"duplicate grouping columns: {group_by}")
    return group_by


def _is_real() -> F.Column:
    return F.coalesce(F.col("order_status").isin(*REAL_SALE_STATUSES), F.lit(False))


def kpi_partials(fact: DataFrame, group_by: list[str]) -> DataFrame:
    """Additive KPI inputs per group: one pass, partial aggregation map-side.
    Each revenue is kept as the sums of its exact parts (``arith.money_parts``)."""
    group_by = _check_group_by(group_by)
    rev = zero_if_null(F.col("revenue_eur"))
    rows = {"real": _is_real(), "delivered": F.col("order_status") == "delivered",
            "returned": F.col("order_status") == "returned"}
    sums = [F.sum(F.when(rows[r], part)).alias(f"{name}_{r}")
            for r in REVENUES for name, part in money_parts(rev).items()]
    return fact.groupBy(*group_by).agg(
        F.count_if(_is_real()).alias("n_real"), *sums,
        F.sum("qty_sold").alias("qty_sold_total"),
        F.sum("qty_ordered").alias("qty_ordered_total"),
    )


def _any_null(cols: list[str]) -> F.Column:
    if not cols:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def finish_kpis(partials: DataFrame, group_by: list[str]) -> DataFrame:
    """KPIs from the additive inputs.  Groups without any real sale are
    absent; a group with a null key keeps its revenue but gets null rates
    (null keys never match in the per-KPI join formulation)."""
    return (partials.filter(F.col("n_real") > 0)
            .select(*group_by, *_kpi_columns(_any_null(group_by))))


def build_kpi_table(fact: DataFrame, group_by: list[str], *, sort: bool = True) -> DataFrame:
    """The three KPIs for one cut, fused into a single aggregation."""
    out = finish_kpis(kpi_partials(fact, group_by), group_by)
    return out.orderBy(*group_by) if (sort and group_by) else out


def kpi_cube(fact: DataFrame, dims: list[str] = CUBE_DIMS) -> DataFrame:
    """Additive inputs at the finest grain every gold cut needs.  Its size is
    bounded by the product of the dimension domains, not by the fact size."""
    return kpi_partials(fact, dims)


def rollup_cut(cube: DataFrame, group_by: list[str], *, sort: bool = True) -> DataFrame:
    """One cut rolled up from the cube (sums of sums)."""
    group_by = _check_group_by(group_by)
    partials = cube.groupBy(*group_by).agg(
        *[F.sum(c).alias(c) for c in PARTIAL_COLS])
    out = finish_kpis(partials, group_by)
    return out.orderBy(*group_by) if (sort and group_by) else out


GOLD_CUTS = {
    "country_month": ["country", "year_month"],
    "channel_category": ["channel", "category"],
    "country_channel": ["country", "channel"],
}


def kpi_all_cuts(fact: DataFrame, cuts: dict[str, list[str]] = GOLD_CUTS) -> DataFrame:
    """All gold cuts in one long table (``cut`` names the grouping).

    One cube at the finest grain the cuts need (the only fact-sized
    shuffle), then one GROUPING SETS aggregation over that small cube.  The
    null-key rule looks only at the columns of a row's own cut
    (``grouping_id`` tells which columns were rolled away)."""
    all_cols = [c for c in CUBE_DIMS if any(c in cols for cols in cuts.values())]
    cube = kpi_cube(fact, all_cols)
    n = len(all_cols)

    def gid(cols):     # bit i (from the left) is 1 when all_cols[i] is rolled away
        return sum(1 << (n - 1 - i) for i, c in enumerate(all_cols) if c not in cols)

    sets = [[F.col(c) for c in cols] for cols in cuts.values()]
    agg = cube.groupingSets(sets, *all_cols).agg(
        *[F.sum(c).alias(c) for c in PARTIAL_COLS], F.grouping_id().alias("_gid"))
    in_cut = [((F.col("_gid").bitwiseAND(F.lit(1 << (n - 1 - i)))) == 0) for i in range(n)]
    null_key = reduce(lambda a, b: a | b,
                      [inc & F.col(c).isNull() for inc, c in zip(in_cut, all_cols)])
    names = {gid(cols): name for name, cols in cuts.items()}
    cut = F.element_at(F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))]),
                       F.col("_gid").cast("int"))
    return (agg.filter(F.col("n_real") > 0)
               .select(cut.alias("cut"), *all_cols, *_kpi_columns(null_key)))


def known_members(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("member").isNotNull())


# -- single KPIs (each its own aggregation), as separately versioned functions --

def gross_revenue(fact: DataFrame, group_by: list[str]) -> DataFrame:
    """KPI v1.0 gross revenue: sum of revenue_eur (null as 0) over real sales."""
    group_by = _check_group_by(group_by)
    return (fact.filter(_is_real()).groupBy(*group_by)
                .agg(money_sum_or_zero(zero_if_null(F.col("revenue_eur"))).alias("revenue_bruto_eur")))


def return_rate(fact: DataFrame, group_by: list[str]) -> DataFrame:
    """KPI v1.0 return rate: returned / (delivered + returned) revenue, 0 for 0/0."""
    group_by = _check_group_by(group_by)
    rev = zero_if_null(F.col("revenue_eur"))
    agg = (fact.filter(_is_real()).groupBy(*group_by)
               .agg(money_sum_or_zero(F.when(F.col("order_status") == "delivered", rev)).alias("d"),
                    money_sum_or_zero(F.when(F.col("order_status") == "returned", rev)).alias("r")))
    return agg.select(*group_by,
                      nan_to_zero(ieee_divide(F.col("r"), F.col("d") + F.col("r"))).alias("return_rate"))


def fulfillment_rate(fact: DataFrame, group_by: list[str]) -> DataFrame:
    """KPI v1.0 fulfillment: sum(qty_sold) / sum(qty_ordered), all statuses."""
    group_by = _check_group_by(group_by)
    agg = fact.groupBy(*group_by).agg(F.sum("qty_sold").alias("s"), F.sum("qty_ordered").alias("o"))
    return agg.select(*group_by, ieee_divide(F.col("s"), F.col("o")).alias("fulfillment_rate"))


def build_kpi_table_joined(fact: DataFrame, group_by: list[str]) -> DataFrame:
    """Three separate KPI aggregations joined on the grouping keys -- the
    literal formulation, kept as an independent check of the fused plan."""
    rev = gross_revenue(fact, group_by)
    out = (rev.join(return_rate(fact, group_by), on=group_by, how="left")
              .join(fulfillment_rate(fact, group_by), on=group_by, how="left"))
    return out.orderBy(*group_by) if group_by else out


def pivot_status_revenue(fact: DataFrame, group_by: list[str]) -> DataFrame:
    """Real-sale revenue per status as columns (delivered, returned); the
    fixed value list means a status absent from the data still yields its
    column, filled with 0."""
    group_by = _check_group_by(group_by)
    piv = (fact.filter(_is_real())
               .groupBy(*group_by)
               .pivot("order_status", REAL_SALE_STATUSES)
               .agg(money_sum(zero_if_null(F.col("revenue_eur")))))
    return piv.select(*group_by, *[F.coalesce(F.col(s), F.lit(0.0)).alias(s)
                                   for s in REAL_SALE_STATUSES])


# The same KPI functions under the names the source system's API uses, so
# existing callers keep working: (fact, group_by) -> DataFrame.
calculate_revenue_bruto = gross_revenue
calculate_return_rate = return_rate
calculate_fulfillment_rate = fulfillment_rate
