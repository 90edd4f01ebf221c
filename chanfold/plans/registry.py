"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
tables in ``sf_dir`` (or over data Spark derives from them).  The oracle is
an independent SQL statement of the same result; ``None`` marks a query with
no SQL equivalent (checked on rows only, and by brute-force unit tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import chanfold.functions.months as fmonths
from chanfold.functions import recode_mod as frecode
from chanfold.functions.arith import money_sum
from chanfold.operators import conform as conf
from chanfold.operators import fx, kpis, loyalty, loyalty_cube
from chanfold.operators import profile as prof
from chanfold.operators import quality as qual
from chanfold.operators import quarantine as quar
from chanfold.plans import oracle_sql as osql
from chanfold.plans import raw_dialects as raw
from chanfold.plans import raw_files
from chanfold.plans.layers import Layers, code_fingerprint, materialize, materialize_bucketed, published
from chanfold.plans.raw_dialects import RAW_SCHEMAS
from chanfold.plans.report import present, present_kpis
from chanfold.session import work_dir
from chanfold.sources import ingest as ing
from chanfold.sources import readers as rd
from chanfold.specs import (CATEGORY_FIX, CHANNEL_SPECS, COUNTRY_ISO3_TO_ISO2,
                            COUNTRY_NAME_TO_ISO2, ECOMM_CATCODE_TO_CATEGORY,
                            FRANCHISE_STATUS_MAP, WHOLESALE_CATCODE_TO_CATEGORY)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


REAL = "order_status IN ('delivered', 'returned')"
M = osql.MONEY_REV


# ---------------------------------------------------------------- gold KPIs

def _kpi_cut(name: str, group_by: list[str]):
    @register(name, osql.kpi_joined_sql(group_by))
    def q(spark, sf_dir):
        return present_kpis(kpis.build_kpi_table(Layers(spark, sf_dir).fact_eur(), group_by))
    return q


_kpi_cut("kpi_country_month", ["country", "year_month"])
_kpi_cut("kpi_channel_category", ["channel", "category"])
_kpi_cut("kpi_country_channel", ["country", "channel"])


def _kpi_rollup(name: str, group_by: list[str]):
    """One-dimension executive cuts, rolled up from the shared cube."""
    @register(name, osql.kpi_joined_sql(group_by))
    def q(spark, sf_dir):
        cube = kpis.kpi_cube(Layers(spark, sf_dir).fact_eur())
        return present_kpis(kpis.rollup_cut(cube, group_by))
    return q


_kpi_rollup("kpi_country", ["country"])
_kpi_rollup("kpi_channel", ["channel"])
_kpi_rollup("kpi_month", ["year_month"])


@register("kpi_member", osql.kpi_joined_sql(["member"], where="member IS NOT NULL"))
def _kpi_member(spark, sf_dir):
    fact = kpis.known_members(Layers(spark, sf_dir).fact_eur())
    return present_kpis(kpis.build_kpi_table(fact, ["member"]))


@register("kpi_channel_member",
          osql.kpi_joined_sql(["channel", "member"], where="member IS NOT NULL"))
def _kpi_channel_member(spark, sf_dir):
    fact = kpis.known_members(Layers(spark, sf_dir).fact_eur())
    return present_kpis(kpis.build_kpi_table(fact, ["channel", "member"]))


@register("kpi_table_joined", osql.kpi_joined_sql(["country", "year_month"]))
def _kpi_table_joined(spark, sf_dir):
    fact = Layers(spark, sf_dir).fact_eur()
    return present_kpis(kpis.build_kpi_table_joined(fact, ["country", "year_month"]))


def _all_cuts_sql() -> str:
    parts = []
    for name, cols in kpis.GOLD_CUTS.items():
        g = ", ".join(cols)
        sel = ", ".join(c if c in cols else f"CAST(NULL AS VARCHAR) AS {c}"
                        for c in ["country", "channel", "category", "year_month"])
        parts.append(f"""
SELECT '{name}' AS cut, {sel},
  CAST(round(kahan_sum(CASE WHEN {REAL} THEN {M} END), 4) AS DOUBLE) AS revenue_bruto_eur,
  round(CASE WHEN coalesce(kahan_sum(CASE WHEN {REAL} THEN {M} END), 0) = 0 THEN 0.0
        ELSE CAST(coalesce(kahan_sum(CASE WHEN order_status = 'returned' THEN {M} END), 0) AS DOUBLE)
             / CAST(kahan_sum(CASE WHEN {REAL} THEN {M} END) AS DOUBLE) END, 6) AS return_rate,
  round(CAST(sum(qty_sold) AS DOUBLE) / CAST(sum(qty_ordered) AS DOUBLE), 6) AS fulfillment_rate
FROM fact_eur GROUP BY {g}
HAVING count(*) FILTER (WHERE {REAL}) > 0""")
    return osql.with_base("\nUNION ALL\n".join(parts))


@register("kpi_all_cuts", _all_cuts_sql())
def _kpi_all_cuts(spark, sf_dir):
    return present_kpis(kpis.kpi_all_cuts(Layers(spark, sf_dir).fact_eur()))


@register("gross_revenue", osql.with_base(f"""
SELECT channel, category, CAST(round(kahan_sum({M}), 4) AS DOUBLE) AS revenue_bruto_eur
FROM fact_eur WHERE {REAL} GROUP BY channel, category"""))
def _gross_revenue(spark, sf_dir):
    return present(kpis.gross_revenue(Layers(spark, sf_dir).fact_eur(), ["channel", "category"]),
                   money=["revenue_bruto_eur"])


_EXTREME_SQL = "CASE qty_ordered % 5 WHEN 0 THEN revenue_eur * 1e13 WHEN 1 THEN -revenue_eur * 1e13 " \
    "WHEN 2 THEN revenue_eur * 4e-7 WHEN 3 THEN -revenue_eur ELSE revenue_eur END"


@register("exact_sums", osql.with_base(f"""
SELECT channel, CAST(sum(whole) AS DOUBLE) AS whole_units, CAST(count(x) AS BIGINT) AS n_values, TRUE AS same_everywhere
FROM (SELECT channel, {_EXTREME_SQL} AS x, CAST(trunc({_EXTREME_SQL}) AS DECIMAL(38,0)) AS whole FROM fact_eur) v
GROUP BY channel"""))
def _exact_sums(spark, sf_dir):
    """Sums of amounts from 4e-7 to 1e13 of the size of the revenue, partly
    cancelling: the whole units against exact decimals, and all of them twice,
    dealt in two ways, bit for bit."""
    n, x = F.col("qty_ordered") % 5, F.col("revenue_eur")
    extreme = (F.when(n == 0, x * 1e13).when(n == 1, -x * 1e13).when(n == 2, x * 4e-7).when(n == 3, -x).otherwise(x))
    fact = Layers(spark, sf_dir).fact_eur().select("channel", extreme.alias("x"))
    # Whole units: the amount without what is left of it after division by one.
    sums = lambda df: df.groupBy("channel").agg(
        money_sum(F.col("x") - F.col("x") % 1.0).alias("whole_units"), money_sum("x").alias("total"),
        F.count("x").alias("n_values"))
    other = sums(fact.repartition(7, "x")).select(F.col("channel").alias("c"), F.col("total").alias("again"))
    return sums(fact).join(other, F.col("channel") == F.col("c")).select(
        "channel", "whole_units", "n_values", (F.col("total") == F.col("again")).alias("same_everywhere"))


@register("return_rate", osql.with_base(f"""
SELECT channel, category,
  round(CASE WHEN kahan_sum({M}) = 0 THEN 0.0
        ELSE CAST(coalesce(kahan_sum(CASE WHEN order_status = 'returned' THEN {M} END), 0) AS DOUBLE)
             / CAST(kahan_sum({M}) AS DOUBLE) END, 6) AS return_rate
FROM fact_eur WHERE {REAL} GROUP BY channel, category"""))
def _return_rate(spark, sf_dir):
    return present(kpis.return_rate(Layers(spark, sf_dir).fact_eur(), ["channel", "category"]),
                   ratios=["return_rate"])


@register("fulfillment_rate", osql.with_base("""
SELECT country, year_month,
  round(CAST(sum(qty_sold) AS DOUBLE) / CAST(sum(qty_ordered) AS DOUBLE), 6) AS fulfillment_rate
FROM fact_eur GROUP BY country, year_month"""))
def _fulfillment_rate(spark, sf_dir):
    return present(kpis.fulfillment_rate(Layers(spark, sf_dir).fact_eur(), ["country", "year_month"]),
                   ratios=["fulfillment_rate"])


@register("pivot_status_revenue", osql.with_base(f"""
SELECT channel,
  CAST(round(coalesce(kahan_sum(CASE WHEN order_status = 'delivered' THEN {M} END), 0), 4) AS DOUBLE) AS delivered,
  CAST(round(coalesce(kahan_sum(CASE WHEN order_status = 'returned' THEN {M} END), 0), 4) AS DOUBLE) AS returned
FROM fact_eur WHERE {REAL} GROUP BY channel"""))
def _pivot_status_revenue(spark, sf_dir):
    return present(kpis.pivot_status_revenue(Layers(spark, sf_dir).fact_eur(), ["channel"]),
                   money=["delivered", "returned"])


@register("count_by_channel_category", osql.with_base("""
SELECT channel, category, count(*) AS n_lines FROM fact GROUP BY channel, category"""))
def _count_by_channel_category(spark, sf_dir):
    return (Layers(spark, sf_dir).fact().groupBy("channel", "category")
            .agg(F.count(F.lit(1)).alias("n_lines")))


@register("filter_real_sales", osql.with_base(f"""
SELECT channel, order_status, count(*) AS n_lines,
  CAST(round(kahan_sum({M}), 4) AS DOUBLE) AS revenue_eur
FROM fact_eur WHERE {REAL} GROUP BY channel, order_status"""))
def _filter_real_sales(spark, sf_dir):
    fact = Layers(spark, sf_dir).fact_eur()
    out = (fact.filter(F.col("order_status").isin("delivered", "returned"))
               .groupBy("channel", "order_status")
               .agg(F.count(F.lit(1)).alias("n_lines"),
                    money_sum(F.coalesce("revenue_eur", F.lit(0.0))).alias("revenue_eur")))
    return present(out, money=["revenue_eur"])


@register("filter_known_members", osql.with_base("""
SELECT channel, member, count(*) AS n_lines FROM fact WHERE member IS NOT NULL
GROUP BY channel, member"""))
def _filter_known_members(spark, sf_dir):
    return (kpis.known_members(Layers(spark, sf_dir).fact())
            .groupBy("channel", "member").agg(F.count(F.lit(1)).alias("n_lines")))


# ------------------------------------------------------------------ currency

@register("fx_convert", osql.with_base("SELECT * FROM fact_eur"))
def _fx_convert(spark, sf_dir):
    """Computed from the tables, not read from the written silver layer."""
    return Layers(spark, sf_dir).fact_eur_lazy()


@register("fx_join", osql.with_base(f"SELECT {osql.FACT_COLS_SQL}, local_units_per_eur FROM fact_rated"))
def _fx_join(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    return fx.join_rates(layers.fact(), layers.rates())


@register("fx_missing_rates", osql.with_base("""
SELECT channel, country, year_month, count(*) AS n_rows FROM fact_rated
WHERE currency <> 'EUR' AND local_units_per_eur IS NULL
GROUP BY channel, country, year_month"""))
def _fx_missing_rates(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    return fx.missing_rates(layers.fact(), layers.rates())


@register("validate_rates", osql.with_base("""
SELECT rule, violations FROM (
  SELECT 'duplicate_keys' AS rule,
    CAST((SELECT count(*) FROM (SELECT country, year_month FROM rates GROUP BY ALL HAVING count(*) > 1)) AS BIGINT) AS violations
  UNION ALL SELECT 'non_positive_rate', CAST(count(*) FILTER (WHERE local_units_per_eur IS NULL OR local_units_per_eur <= 0) AS BIGINT) FROM rates
  UNION ALL SELECT 'bad_month_format', CAST(count(*) FILTER (WHERE NOT coalesce(regexp_full_match(year_month, '[0-9]{4}-[0-9]{2}'), FALSE)) AS BIGINT) FROM rates
  UNION ALL SELECT 'null_country', CAST(count(*) FILTER (WHERE country IS NULL) AS BIGINT) FROM rates
  UNION ALL SELECT 'currency_to_not_eur', CAST(count(*) FILTER (WHERE NOT coalesce(currency_to = 'EUR', FALSE)) AS BIGINT) FROM rates
)"""))
def _validate_rates(spark, sf_dir):
    return fx.validate_rates(Layers(spark, sf_dir).rates())


def _faulty_rates(rates: DataFrame) -> DataFrame:
    """The rate table with every kind of fault planted."""
    month = F.substring("year_month", 6, 2)
    changed = rates.withColumns({
        "local_units_per_eur": F.when(month == "06", F.lit(0.0)).when(month == "05", F.lit(None).cast("double"))
        .otherwise(F.col("local_units_per_eur")),
        "year_month": F.when(month == "07", F.regexp_replace("year_month", "-", "/")).otherwise(F.col("year_month")),
        "currency_to": F.when(F.col("country") == "PE", F.lit("USD")).otherwise(F.col("currency_to")),
        "country": F.when((F.col("country") == "CL") & (month == "02"), F.lit(None).cast("string"))
        .otherwise(F.col("country"))})
    return changed.unionByName(rates.where(F.col("country") == "AR"))


@register("validate_rates_faults", osql.with_base("""
SELECT rule, violations FROM (
  SELECT 'duplicate_keys' AS rule,
    CAST((SELECT count(*) FROM (SELECT country, year_month FROM faulty GROUP BY ALL HAVING count(*) > 1)) AS BIGINT) AS violations
  UNION ALL SELECT 'non_positive_rate', CAST(count(*) FILTER (WHERE local_units_per_eur IS NULL OR local_units_per_eur <= 0) AS BIGINT) FROM faulty
  UNION ALL SELECT 'bad_month_format', CAST(count(*) FILTER (WHERE NOT coalesce(regexp_full_match(year_month, '[0-9]{4}-[0-9]{2}'), FALSE)) AS BIGINT) FROM faulty
  UNION ALL SELECT 'null_country', CAST(count(*) FILTER (WHERE country IS NULL) AS BIGINT) FROM faulty
  UNION ALL SELECT 'currency_to_not_eur', CAST(count(*) FILTER (WHERE NOT coalesce(currency_to = 'EUR', FALSE)) AS BIGINT) FROM faulty
)""", """
faulty AS (
  SELECT CASE WHEN country = 'CL' AND substr(year_month, 6, 2) = '02' THEN NULL ELSE country END AS country,
    CASE WHEN substr(year_month, 6, 2) = '07' THEN replace(year_month, '-', '/') ELSE year_month END AS year_month,
    CASE WHEN country = 'PE' THEN 'USD' ELSE currency_to END AS currency_to,
    CASE substr(year_month, 6, 2) WHEN '06' THEN 0.0 WHEN '05' THEN NULL ELSE local_units_per_eur END AS local_units_per_eur
  FROM rates
  UNION ALL SELECT country, year_month, currency_to, local_units_per_eur FROM rates WHERE country = 'AR')"""))
def _validate_rates_faults(spark, sf_dir):
    return fx.validate_rates(_faulty_rates(Layers(spark, sf_dir).rates()))


@register("currency_reference", osql.with_base("SELECT * FROM rates"))
def _currency_reference(spark, sf_dir):
    return Layers(spark, sf_dir).rates()


# ------------------------------------------------------------------- loyalty

_MEMBER_CMP_SQL = f"""
SELECT member,
  kahan_sum({M}) AS revenue_total,
  count(*) AS num_lineas,
  CAST(count(DISTINCT order_id) + max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS num_ordenes_unicas
FROM fact_eur WHERE member IS NOT NULL AND {REAL} GROUP BY member"""


@register("member_comparison", osql.with_base(f"""
SELECT member, CAST(round(revenue_total, 4) AS DOUBLE) AS revenue_total, num_lineas, num_ordenes_unicas,
  round(CAST(revenue_total AS DOUBLE) / num_ordenes_unicas, 4) AS avg_revenue_por_orden
FROM ({_MEMBER_CMP_SQL}) c"""))
def _member_comparison(spark, sf_dir):
    return present(loyalty_cube.member_comparison(*Layers(spark, sf_dir).loyalty_cube()),
                   money=["revenue_total", "avg_revenue_por_orden"])


@register("member_orders_by_channel", osql.with_base(f"""
SELECT channel, member,
  CAST(count(DISTINCT order_id) + max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS num_ordenes
FROM fact_eur WHERE member IS NOT NULL AND {REAL} GROUP BY channel, member"""))
def _member_orders_by_channel(spark, sf_dir):
    return loyalty_cube.member_orders_by_channel(*Layers(spark, sf_dir).loyalty_cube())


@register("orders_by_member", osql.with_base(f"""
SELECT member,
  CAST(count(DISTINCT order_id) + max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS num_ordenes,
  count(*) AS num_lineas
FROM fact_eur WHERE {REAL} GROUP BY member"""))
def _orders_by_member(spark, sf_dir):
    return loyalty_cube.orders_by_member(*Layers(spark, sf_dir).loyalty_cube())


@register("member_uplift", osql.with_base(f"""
SELECT member_orders, non_member_orders, round(member_avg_ticket, 4) AS member_avg_ticket,
  CAST(0.1 AS DOUBLE) AS share,
  round(CAST(member_orders AS DOUBLE) / non_member_orders, 6) AS uplift_ratio,
  round(non_member_orders * 0.1 * (CAST(member_orders AS DOUBLE) / non_member_orders - 1), 4) AS potential_new_orders,
  round(non_member_orders * 0.1 * (CAST(member_orders AS DOUBLE) / non_member_orders - 1) * member_avg_ticket, 4) AS potential_revenue
FROM (
  SELECT max(CASE WHEN member THEN num_ordenes_unicas END) AS member_orders,
         max(CASE WHEN NOT member THEN num_ordenes_unicas END) AS non_member_orders,
         max(CASE WHEN member THEN CAST(revenue_total AS DOUBLE) / num_ordenes_unicas END) AS member_avg_ticket
  FROM ({_MEMBER_CMP_SQL}) c
) u"""))
def _member_uplift(spark, sf_dir):
    cmp_ = loyalty_cube.member_comparison(*Layers(spark, sf_dir).loyalty_cube())
    return present(loyalty.member_uplift(cmp_, share=0.10),
                   money=["member_avg_ticket", "potential_new_orders", "potential_revenue"],
                   ratios=["uplift_ratio"])


# -------------------------------------------------------------------- silver



def raw_frame(spark, sf_dir, channel: str) -> DataFrame:
    return raw.RAW_ENCODERS[channel](Layers(spark, sf_dir).fact())


def ecomm_lines(spark, sf_dir) -> DataFrame:
    """Ecomm order lines in raw column names, i.e. the nested orders after
    explode.  Analyses of lines read them directly; the nesting and explode
    themselves are exercised by ``explode_order_lines``, ``conform_ecomm``,
    ``ingest_ndjson`` and ``fact_orders``."""
    return raw.ecomm_lines_flat(Layers(spark, sf_dir).fact())


def _conform_key(channel: str):
    body = f"SELECT * FROM ({osql.CONFORMED_CTE_BODY}) c WHERE channel = '{channel}'"

    @register(f"conform_{channel}", osql.with_base(body))
    def q(spark, sf_dir):
        return conf.conform(raw_frame(spark, sf_dir, channel), CHANNEL_SPECS[channel])
    return q


for _ch in ["retail", "ecomm", "app", "wholesale", "franchise"]:
    _conform_key(_ch)


@register("explode_order_lines", osql.with_raw("SELECT * FROM raw_ecomm_flat"))
def _explode_order_lines(spark, sf_dir):
    return conf.flatten_lines(raw_frame(spark, sf_dir, "ecomm"), "lines")


@register("fact_orders", osql.with_base(osql.CONFORMED_CTE_BODY))
def _fact_orders(spark, sf_dir):
    fact = Layers(spark, sf_dir).fact()
    sources = {f"{ch}_orders": enc(fact) for ch, enc in raw.RAW_ENCODERS.items()}
    return conf.build_fact_orders(sources)


def _pairs(df: DataFrame, channel: str, raw_col: str, value) -> DataFrame:
    return (df.select(F.lit(channel).alias("channel"),
                      F.col(raw_col).cast("string").alias("raw_value"),
                      value.alias("value"))
              .groupBy("channel", "raw_value", "value").agg(F.count(F.lit(1)).alias("n")))


def _pairs_sql(channel: str, source: str, raw_col: str, value_sql: str) -> str:
    return (f"SELECT '{channel}' AS channel, CAST({raw_col} AS VARCHAR) AS raw_value, "
            f"{value_sql} AS value, count(*) AS n FROM {source} GROUP BY ALL")


def _pairs_key(name: str, parts: list[tuple]):
    """Scalar-function check over real data: distinct (raw, normalized) pairs
    with their counts.  parts: (channel, raw column, Spark fn, SQL expr)."""
    sql = osql.with_raw("\nUNION ALL\n".join(
        _pairs_sql(ch, f"raw_{ch}" if ch != "ecomm" else "raw_ecomm_flat", col, sql_expr)
        for ch, col, _, sql_expr in parts))

    @register(name, sql)
    def q(spark, sf_dir):
        frames = []
        for ch, col, fn, _ in parts:
            src = ecomm_lines(spark, sf_dir) if ch == "ecomm" else raw_frame(spark, sf_dir, ch)
            frames.append(_pairs(src, ch, col, fn(col)))
        return prof.union_all(frames)
    return q


_case = osql.sql_case
_ecomm_codes = {str(k): v for k, v in osql.CATEGORY_OF_NUMBER.items()}

_pairs_key("recode_country", [
    ("retail", "store_country", lambda c: frecode.recode(c, COUNTRY_NAME_TO_ISO2),
     _case("store_country", osql.ISO2_OF_NAME, passthrough=True)),
    ("app", "cc", lambda c: frecode.recode(c, COUNTRY_ISO3_TO_ISO2),
     _case("cc", osql.ISO2_OF_ISO3, passthrough=True)),
])
_pairs_key("recode_category", [
    (ch, col, lambda c: frecode.recode(c, CATEGORY_FIX), _case(col, osql.CATEGORY_OF_TEXT, passthrough=True))
    for ch, col in [("retail", "product_category"), ("app", "category"), ("franchise", "Categoria")]
])
_pairs_key("recode_category_code", [
    ("ecomm", "catCode", lambda c: frecode.recode_code(c, ECOMM_CATCODE_TO_CATEGORY),
     _case("CAST(catCode AS VARCHAR)", _ecomm_codes, passthrough=True)),
    ("wholesale", "category_code", lambda c: frecode.recode_code(c, WHOLESALE_CATCODE_TO_CATEGORY),
     _case("category_code", osql.CATEGORY_OF_CODE, passthrough=True)),
])
_pairs_key("recode_status", [
    ("retail", "order_state", frecode.lower_status, "lower(order_state)"),
    ("app", "fulfillment", frecode.lower_status, "lower(fulfillment)"),
    ("franchise", "Estado_Orden", lambda c: frecode.recode(c, FRANCHISE_STATUS_MAP),
     _case("Estado_Orden", osql.STATUS_OF_TEXT, passthrough=True)),
])
_pairs_key("member_flag", [
    ("retail", "loyalty_flag", lambda c: frecode.decode_flag(c, "Y", "N"),
     "CASE WHEN loyalty_flag = 'Y' THEN TRUE WHEN loyalty_flag = 'N' THEN FALSE END"),
    ("franchise", "AdiClub", lambda c: frecode.decode_flag(c, "Si", "No"),
     "CASE WHEN AdiClub = 'Si' THEN TRUE WHEN AdiClub = 'No' THEN FALSE END"),
    ("app", "member", lambda c: frecode.decode_flag(c, "Y", None),
     "CASE WHEN member = 'Y' THEN TRUE END"),
])
_pairs_key("month_spanish", [
    ("franchise", "Mes", fmonths.month_from_spanish,
     "split_part(Mes, '-', 2) || '-' || "
     + _case("split_part(Mes, '-', 1)", osql.NUMBER_OF_MONTH, passthrough=True)),
])
_pairs_key("month_int", [
    ("ecomm", "period", fmonths.month_from_int,
     "substr(CAST(period AS VARCHAR), 1, 4) || '-' || substr(CAST(period AS VARCHAR), 5, 2)"),
])
_pairs_key("month_slash", [
    ("app", "yearmonth", fmonths.month_from_slash, "regexp_replace(yearmonth, '/', '-')"),
])
_pairs_key("month_timestamp", [
    ("wholesale", "yr_month", fmonths.month_from_timestamp, "strftime(yr_month, '%Y-%m')"),
])
_pairs_key("cast_ids", [
    ("app", "productId", lambda c: F.col(c).cast("string"), "CAST(productId AS VARCHAR)"),
    ("ecomm", "article", lambda c: F.col(c).cast("string"), "CAST(article AS VARCHAR)"),
])


@register("derive_revenue", osql.with_raw("""
SELECT country_code AS country, count(*) FILTER (WHERE sell_out_units * avg_price IS NULL) AS null_revenue,
  CAST(round(kahan_sum(sell_out_units * avg_price), 4) AS DOUBLE) AS revenue_local
FROM raw_wholesale GROUP BY country_code"""))
def _derive_revenue(spark, sf_dir):
    df = conf.derive_revenue(conf.rename_strict(raw_frame(spark, sf_dir, "wholesale"),
                                                CHANNEL_SPECS["wholesale"].rename))
    return present(df.groupBy("country").agg(
        F.count_if(F.col("revenue_local").isNull()).alias("null_revenue"),
        money_sum("revenue_local").alias("revenue_local")), money=["revenue_local"])


@register("derive_unit_price", osql.with_raw("""
SELECT cc AS country, count(*) FILTER (WHERE sold <= 0) AS null_unit_price,
  CAST(round(kahan_sum(CASE WHEN sold > 0 THEN amount / sold END), 4) AS DOUBLE) AS unit_price_total
FROM raw_app GROUP BY cc"""))
def _derive_unit_price(spark, sf_dir):
    df = conf.derive_unit_price(conf.rename_strict(raw_frame(spark, sf_dir, "app"),
                                                   CHANNEL_SPECS["app"].rename))
    return present(df.groupBy("country").agg(
        F.count_if(F.col("unit_price").isNull()).alias("null_unit_price"),
        money_sum("unit_price").alias("unit_price_total")), money=["unit_price_total"])


# ------------------------------------------------------ profiling and quality


FACT_EUR_TYPES = [
    ("channel", "string"), ("consumer_id", "string"), ("order_id", "string"),
    ("country", "string"), ("year_month", "string"), ("category", "string"),
    ("product_id", "string"), ("qty_ordered", "bigint"), ("qty_sold", "bigint"),
    ("unit_price", "double"), ("currency", "string"), ("revenue_local", "double"),
    ("order_status", "string"), ("member", "boolean"), ("revenue_eur", "double"),
    ("unit_price_eur", "double"),
]
NUMERIC_FACT_COLS = ["qty_ordered", "qty_sold", "unit_price", "revenue_local", "revenue_eur",
                     "unit_price_eur"]
PROFILED_COLS = ["channel", "country", "year_month", "category", "order_status", "currency",
                 "member"]
VALIDATED_COLS = ["channel", "country", "category", "order_status", "year_month"]


@register("null_counts", osql.with_base(
    "UNPIVOT (SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
                                   for c, _ in FACT_EUR_TYPES)
    + " FROM fact_eur) ON COLUMNS(*) INTO NAME column_name VALUE null_count"))
def _null_counts(spark, sf_dir):
    return prof.null_counts(Layers(spark, sf_dir).fact_eur())


@register("value_counts", osql.with_base(
    "SELECT order_status AS value, count(*) AS n FROM fact GROUP BY order_status"))
def _value_counts(spark, sf_dir):
    return prof.value_counts(Layers(spark, sf_dir).fact(), "order_status")


def _distinct_pairs_sql(cols: list[str], source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {source}"
        for c in cols)


@register("distinct_values", osql.with_base(_distinct_pairs_sql(VALIDATED_COLS, "fact")))
def _distinct_values(spark, sf_dir):
    return prof.distinct_values(Layers(spark, sf_dir).fact(), VALIDATED_COLS)


@register("profile_distinct", osql.with_base(f"""
SELECT column_name, value, value_rank, n_distinct FROM (
  SELECT column_name, value,
    row_number() OVER (PARTITION BY column_name ORDER BY value ASC NULLS FIRST) AS value_rank,
    count(*) OVER (PARTITION BY column_name) AS n_distinct
  FROM ({_distinct_pairs_sql(PROFILED_COLS, 'fact')}) p
) r WHERE value_rank <= 15"""))
def _profile_distinct(spark, sf_dir):
    out = prof.profile_distinct(Layers(spark, sf_dir).fact(), PROFILED_COLS, n=15)
    return out.withColumn("value_rank", F.col("value_rank").cast("bigint"))


FREQUENT_COLS = ["consumer_id", "order_id", "product_id", "year_month", "member", "qty_ordered", "unit_price"]
_TEXT_OF = {"unit_price": "CAST(round(unit_price * 100) AS BIGINT)"}


@register("frequent_values", osql.with_base("SELECT column_name, value, value_rank, n FROM ("
    "SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value ASC NULLS FIRST) AS value_rank FROM ("
    + "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, CAST({_TEXT_OF.get(c, c)} AS VARCHAR) AS value, count(*) AS n "
                           f"FROM fact GROUP BY 2" for c in FREQUENT_COLS) + ") v) r WHERE value_rank <= 15"))
def _frequent_values(spark, sf_dir):
    """The 15 most frequent values of columns with many and with few values
    (prices in cents)."""
    fact = Layers(spark, sf_dir).fact().withColumn("unit_price", F.round(F.col("unit_price") * 100).cast("bigint"))
    return prof.frequent_values(fact, FREQUENT_COLS)


@register("describe_numeric", osql.with_base("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, "
    f"min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max FROM fact_eur"
    for c in NUMERIC_FACT_COLS)))
def _describe_numeric(spark, sf_dir):
    out = prof.describe_numeric(Layers(spark, sf_dir).fact_eur(), NUMERIC_FACT_COLS)
    return present(out, money=["mean", "std"])


@register("describe_quantiles", None)
def _describe_quantiles(spark, sf_dir):
    return prof.describe_quantiles(Layers(spark, sf_dir).fact_eur(), NUMERIC_FACT_COLS)


@register("profile_source", osql.with_base("\nUNION ALL\n".join(
    f"SELECT 'fact_orders' AS source, count(*) AS n_rows, {i + 1} AS position, '{c}' AS column_name, "
    f"'{t}' AS data_type, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM fact_eur"
    for i, (c, t) in enumerate(FACT_EUR_TYPES))))
def _profile_source(spark, sf_dir):
    return prof.profile_source(Layers(spark, sf_dir).fact_eur(), "fact_orders")


@register("sample_rows", osql.with_base(
    "SELECT * FROM fact ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in
                                               osql.FACT_COLS_SQL.split(", ")) + " LIMIT 10"))
def _sample_rows(spark, sf_dir):
    return prof.sample_rows(Layers(spark, sf_dir).fact(), 10)


def _app_labelled(spark, sf_dir) -> DataFrame:
    app = raw_frame(spark, sf_dir, "app")
    return app.withColumn("category_clean", frecode.recode("category", CATEGORY_FIX))


def product_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Codes and labels by product, stored in buckets of the product, once per
    input snapshot."""
    fp = raw_files._fingerprint(Layers(spark, sf_dir)) + code_fingerprint(prof, _app_labelled)
    return (materialize_bucketed(spark, lambda: prof.code_counts(ecomm_lines(spark, sf_dir), "catCode", "article"),
                                 "coded_products", fp, "key", "code bigint, key bigint, n bigint"),
            materialize_bucketed(spark, lambda: prof.key_labels(_app_labelled(spark, sf_dir), "category_clean", "productId"),
                                 "labelled_products", fp, "key", "key bigint, label string"))


def _crosstab(spark, sf_dir) -> DataFrame:
    return prof.crosstab_of(*product_tables(spark, sf_dir))


_CROSSTAB_SQL = f"""
SELECT e.catCode AS code, a.label, count(*) AS count
FROM raw_ecomm_flat e
JOIN (SELECT DISTINCT productId AS key, {osql.sql_case('category', osql.CATEGORY_OF_TEXT, passthrough=True)} AS label
      FROM raw_app) a ON CAST(e.article AS BIGINT) = a.key
GROUP BY e.catCode, a.label"""


@register("category_crosstab", osql.with_raw(_CROSSTAB_SQL))
def _category_crosstab(spark, sf_dir):
    return _crosstab(spark, sf_dir)


@register("code_inference", osql.with_raw(f"""
SELECT code, arg_max(label, {{'n': count, 'label': label}}) AS inferred_label,
  round(CAST(max(count) AS DOUBLE) / sum(count), 6) AS share, CAST(sum(count) AS BIGINT) AS n_matched
FROM ({_CROSSTAB_SQL}) x GROUP BY code"""))
def _code_inference(spark, sf_dir):
    return present(prof.infer_code_mapping(_crosstab(spark, sf_dir)), ratios=["share"])


@register("id_overlap", osql.with_raw("""
SELECT 'ecomm_app' AS pair, count(*) AS overlap FROM (
  SELECT CAST(article AS VARCHAR) FROM raw_ecomm_flat INTERSECT SELECT CAST(productId AS VARCHAR) FROM raw_app) a
UNION ALL
SELECT 'ecomm_wholesale' AS pair, count(*) AS overlap FROM (
  SELECT CAST(article AS VARCHAR) FROM raw_ecomm_flat INTERSECT SELECT CAST(material_id AS VARCHAR) FROM raw_wholesale) b"""))
def _id_overlap(spark, sf_dir):
    ecomm = ecomm_lines(spark, sf_dir)
    a = prof.id_overlap(ecomm, "article", raw_frame(spark, sf_dir, "app"), "productId")
    b = prof.id_overlap(ecomm, "article", raw_frame(spark, sf_dir, "wholesale"), "material_id")
    return prof.union_all([a.select(F.lit("ecomm_app").alias("pair"), "overlap"),
                           b.select(F.lit("ecomm_wholesale").alias("pair"), "overlap")])


# Columns that hold ids, by source.
ID_COLUMNS = {
    "retail": ["transaction_id", "consumer_id", "sku"],
    "ecomm": ["orderId", "customerId", "article"],
    "app": ["uid", "productId", "orderRef"],
    "wholesale": ["material_id"],
    "franchise": ["Num_Orden", "Consumidor", "Codigo_Producto"],
}


def _id_overlaps_sql() -> str:
    table = lambda s: "raw_ecomm_flat" if s == "ecomm" else f"raw_{s}"
    names = [(s, c) for s, cols in ID_COLUMNS.items() for c in cols]
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS left_source, '{x}' AS left_column, '{b}' AS right_source, '{y}' AS right_column, "
        f"count(*) AS overlap FROM (SELECT CAST({x} AS VARCHAR) FROM {table(a)} INTERSECT "
        f"SELECT CAST({y} AS VARCHAR) FROM {table(b)}) v"
        for i, (a, x) in enumerate(names) for b, y in names[i + 1:] if a != b)


@register("id_overlaps", osql.with_raw(_id_overlaps_sql()))
def _id_overlaps(spark, sf_dir):
    """Shared ids of every pair of id columns of different sources."""
    layers = Layers(spark, sf_dir)
    frames = {s: (ecomm_lines(spark, sf_dir) if s == "ecomm" else raw_frame(spark, sf_dir, s), cols)
              for s, cols in ID_COLUMNS.items()}
    fp = layers.fingerprint(["lineitem", "orders", "customer", "part"], prof, raw) + code_fingerprint(_id_overlaps)
    return prof.id_overlaps(frames, materialize(spark, lambda: prof.id_sketches(frames), "id_sketches", fp))


QUANTILE_DIMS = ["country", "channel", "category"]


@register("quartiles_by_cut", osql.with_base("\nUNION ALL\n".join(
    f"SELECT country, channel, '{c}' AS column_name, CAST({p} AS DOUBLE) AS p, count({c}) AS n, TRUE AS within "
    f"FROM fact_eur GROUP BY country, channel HAVING count({c}) > 0" for c in NUMERIC_FACT_COLS for p in (0.25, 0.5, 0.75))))
def _quartiles_by_cut(spark, sf_dir):
    """Quartiles per country and channel from sketches stored per cell, each
    checked to be within the sketch's rank error of the exact rank."""
    layers = Layers(spark, sf_dir)
    fp = layers.fingerprint(["lineitem", "orders", "customer", "part"], prof)
    cells = materialize(spark, lambda: prof.quantile_cells(layers.fact_eur(), QUANTILE_DIMS, NUMERIC_FACT_COLS),
                        "quantile_cells", fp)
    by = ["country", "channel"]
    out = prof.checked_quantiles(layers.fact_eur(), prof.quantiles_of_cut(cells, by), by, NUMERIC_FACT_COLS)
    return out.select(*by, "column_name", "p", "n", (F.col("rank_error") <= prof.KLL_ERROR).alias("within"))


_RULES_SQL = {
    "country_not_allowed": "NOT coalesce(country IN ('AR', 'BR', 'CL', 'CO', 'MX', 'PE'), FALSE)",
    "category_not_allowed": "NOT coalesce(category IN ('Football', 'Originals', 'Outdoor', 'Running'), FALSE)",
    "status_not_allowed": "NOT coalesce(order_status IN ('cancelled', 'delivered', 'processing', 'returned'), FALSE)",
    "channel_not_allowed": "NOT coalesce(channel IN ('app', 'ecomm', 'franchise', 'retail', 'wholesale'), FALSE)",
    "month_bad_format": "NOT coalesce(regexp_full_match(year_month, '[0-9]{4}-[0-9]{2}'), FALSE)",
    "null_currency": "currency IS NULL",
    "negative_quantity": "coalesce(qty_ordered < 0 OR qty_sold < 0, FALSE)",
    "sold_exceeds_ordered": "coalesce(qty_sold > qty_ordered, FALSE)",
    "wholesale_null_revenue_with_sales":
        "coalesce(channel = 'wholesale' AND revenue_local IS NULL AND qty_sold <> 0, FALSE)",
    "app_amount_without_sales":
        "coalesce(channel = 'app' AND qty_sold = 0 AND revenue_local <> 0, FALSE)",
}


def _rules_sql(source: str = "fact") -> str:
    sel = ", ".join(f"count(*) FILTER (WHERE {p}) AS {n}" for n, p in _RULES_SQL.items())
    return f"UNPIVOT (SELECT {sel} FROM {source}) ON COLUMNS(*) INTO NAME rule VALUE violations"


def _failed_sql(rules: dict[str, str]) -> str:
    return "concat_ws(' ', " + ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in rules.items()) + ")"


@register("validate_fact", osql.with_base(_rules_sql()))
def _validate_fact(spark, sf_dir):
    return qual.validate_fact(Layers(spark, sf_dir).fact())


def _faulty_fact(fact: DataFrame) -> DataFrame:
    """The fact with every kind of fault planted."""
    n = F.col("qty_ordered")
    plant = lambda c, when, value: F.when(when, value).otherwise(F.col(c))
    return fact.withColumns({
        "country": plant("country", n % 5 == 4, F.lit("XX")),
        "category": plant("category", n % 7 == 3, F.lit("Tennis")),
        "order_status": plant("order_status", n % 11 == 5, F.lit("lost")),
        "channel": plant("channel", n % 13 == 6, F.lit("kiosk")),
        "year_month": plant("year_month", n % 6 == 2, F.regexp_replace("year_month", "-", "/")),
        "currency": plant("currency", n % 9 == 1, F.lit(None).cast("string")),
        "qty_sold": F.when(n % 8 == 1, F.lit(-1).cast("bigint")).when(n % 8 == 7, n + 1).otherwise(F.col("qty_sold")),
        "revenue_local": F.when((F.col("channel") == "wholesale") & (n % 4 == 2), F.lit(None).cast("double"))
        .when((F.col("channel") == "app") & (F.col("qty_sold") == 0), F.lit(1.0)).otherwise(F.col("revenue_local"))})


@register("validate_fact_faults", osql.with_base(_rules_sql("faulty"), """
faulty AS (
  SELECT CASE WHEN qty_ordered % 5 = 4 THEN 'XX' ELSE country END AS country,
    CASE WHEN qty_ordered % 7 = 3 THEN 'Tennis' ELSE category END AS category,
    CASE WHEN qty_ordered % 11 = 5 THEN 'lost' ELSE order_status END AS order_status,
    CASE WHEN qty_ordered % 13 = 6 THEN 'kiosk' ELSE channel END AS channel,
    CASE WHEN qty_ordered % 6 = 2 THEN replace(year_month, '-', '/') ELSE year_month END AS year_month,
    CASE WHEN qty_ordered % 9 = 1 THEN NULL ELSE currency END AS currency, qty_ordered,
    CASE WHEN qty_ordered % 8 = 1 THEN -1 WHEN qty_ordered % 8 = 7 THEN qty_ordered + 1 ELSE qty_sold END AS qty_sold,
    CASE WHEN channel = 'wholesale' AND qty_ordered % 4 = 2 THEN NULL
         WHEN channel = 'app' AND qty_sold = 0 THEN 1.0 ELSE revenue_local END AS revenue_local
  FROM fact)"""))
def _validate_fact_faults(spark, sf_dir):
    return qual.validate_fact(_faulty_fact(Layers(spark, sf_dir).fact()))


_FAULTY_ROWS_CTE = """
faulty AS (
  SELECT * REPLACE (CASE WHEN qty_ordered % 5 = 4 THEN 'XX' ELSE country END AS country,
    CASE WHEN qty_ordered % 7 = 3 THEN 'Tennis' ELSE category END AS category,
    CASE WHEN qty_ordered % 11 = 5 THEN 'lost' ELSE order_status END AS order_status,
    CASE WHEN qty_ordered % 13 = 6 THEN 'kiosk' ELSE channel END AS channel,
    CASE WHEN qty_ordered % 6 = 2 THEN replace(year_month, '-', '/') ELSE year_month END AS year_month,
    CASE WHEN qty_ordered % 9 = 1 THEN NULL ELSE currency END AS currency,
    CASE WHEN qty_ordered % 8 = 1 THEN -1 WHEN qty_ordered % 8 = 7 THEN qty_ordered + 1 ELSE qty_sold END AS qty_sold,
    CASE WHEN channel = 'wholesale' AND qty_ordered % 4 = 2 THEN NULL
         WHEN channel = 'app' AND qty_sold = 0 THEN 1.0 ELSE revenue_local END AS revenue_local)
  FROM fact)"""


def _split(layers: Layers, name: str, df: DataFrame, rules: dict, fp: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A table split by its rules, written once per input snapshot."""
    folder = published(layers.spark, f"{work_dir(layers.spark)}/chanfold-split",
                       f"{name}-{fp}{code_fingerprint(quar, qual, _faulty_fact, _faulty_rates)}",
                       lambda to: quar.write_split(df, rules, to))
    return quar.read_split(layers.spark, folder, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema))


def _both(accepted: DataFrame, quarantined: DataFrame, rules) -> DataFrame:
    kept = accepted.select("*", F.lit("").alias("failed"), F.lit(True).alias("accepted"))
    return kept.unionByName(quarantined.select(*accepted.columns, F.array_join(quar.failed_names(rules), " ").alias("failed"),
                                               F.lit(False).alias("accepted")))


def _fact_split(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    fp = layers.fingerprint(["lineitem", "orders", "customer", "part"])
    return _split(layers, "fact", _faulty_fact(layers.fact()), qual.fact_rules(), fp)


@register("quarantine_fact", osql.with_base(
    f"SELECT *, failed = '' AS accepted FROM (SELECT *, {_failed_sql(_RULES_SQL)} AS failed FROM faulty) f", _FAULTY_ROWS_CTE))
def _quarantine_fact(spark, sf_dir):
    """The fact with planted faults, split by one write: the rows of both parts,
    with the rules that each fails."""
    accepted, quarantined, _ = _fact_split(spark, sf_dir)
    return _both(accepted, quarantined, qual.fact_rules())


@register("quarantine_fact_rules", osql.with_base(_rules_sql("faulty"), _FAULTY_ROWS_CTE))
def _quarantine_fact_rules(spark, sf_dir):
    """Violations by rule, as observed by the write of the split."""
    return _fact_split(spark, sf_dir)[2]


_RATE_RULES_SQL = {
    "duplicate_keys": "rows_of_key > 1",
    "non_positive_rate": "local_units_per_eur IS NULL OR local_units_per_eur <= 0",
    "bad_month_format": "NOT coalesce(regexp_full_match(year_month, '[0-9]{4}-[0-9]{2}'), FALSE)",
    "null_country": "country IS NULL",
    "currency_to_not_eur": "NOT coalesce(currency_to = 'EUR', FALSE)",
}


@register("quarantine_rates", osql.with_base(f"""
SELECT *, failed = '' AS accepted FROM (
  SELECT *, {_failed_sql(_RATE_RULES_SQL)} AS failed
  FROM (SELECT *, count(*) OVER (PARTITION BY country, year_month) AS rows_of_key FROM faulty) k) f""", """
faulty AS (
  SELECT CASE WHEN country = 'CL' AND substr(year_month, 6, 2) = '02' THEN NULL ELSE country END AS country,
    CASE WHEN substr(year_month, 6, 2) = '07' THEN replace(year_month, '-', '/') ELSE year_month END AS year_month,
    CASE WHEN country = 'PE' THEN 'USD' ELSE currency_to END AS currency_to,
    CASE substr(year_month, 6, 2) WHEN '06' THEN 0.0 WHEN '05' THEN NULL ELSE local_units_per_eur END AS local_units_per_eur
  FROM rates
  UNION ALL SELECT country, year_month, currency_to, local_units_per_eur FROM rates WHERE country = 'AR')"""))
def _quarantine_rates(spark, sf_dir):
    """The rate table with planted faults, row by row; a repeated key marks each
    of its rows."""
    layers = Layers(spark, sf_dir)
    rates = _faulty_rates(layers.rates()).select("country", "year_month", "currency_to", "local_units_per_eur")
    accepted, quarantined, _ = _split(layers, "rates", quar.with_key_rows(rates), quar.rate_rules(),
                                      layers.fingerprint(["orders", "customer"]))
    return _both(accepted, quarantined, quar.rate_rules())


@register("null_revenue_diagnosis", osql.with_base("""
SELECT order_status, count(*) AS n_rows,
  count(*) FILTER (WHERE qty_sold IS NULL) AS null_qty_sold,
  count(*) FILTER (WHERE unit_price IS NULL) AS null_unit_price,
  count(*) FILTER (WHERE qty_ordered IS NULL) AS null_qty_ordered,
  count(*) FILTER (WHERE qty_sold = 0) AS zero_qty_sold
FROM fact WHERE channel = 'wholesale' AND revenue_local IS NULL GROUP BY order_status"""))
def _null_revenue_diagnosis(spark, sf_dir):
    return qual.null_revenue_diagnosis(Layers(spark, sf_dir).fact())


@register("avg_revenue_by_channel", osql.with_base("""
SELECT channel,
  round(CAST(kahan_sum(revenue_eur) AS DOUBLE) / count(revenue_eur), 4) AS avg_revenue_eur,
  count(*) FILTER (WHERE revenue_eur IS NULL) AS nulls
FROM fact_eur GROUP BY channel"""))
def _avg_revenue_by_channel(spark, sf_dir):
    return present(qual.avg_revenue_by_channel(Layers(spark, sf_dir).fact_eur()),
                   money=["avg_revenue_eur"])


# ------------------------------------------------------------ bronze (files)



def _raw_path(spark, sf_dir, channel: str) -> tuple[str, Layers]:
    layers = Layers(spark, sf_dir)
    return f"{raw_files.raw_folder(layers)}/{raw_files.RAW_FILE_NAMES[channel]}", layers


def _bronze(spark, sf_dir) -> dict[str, DataFrame]:
    """All raw files ingested, once per input snapshot."""
    return ing.load_layer(spark, raw_files.bronze_folder(Layers(spark, sf_dir)))


@register("source_catalog", None)
def _source_catalog(spark, sf_dir):
    path, layers = _raw_path(spark, sf_dir, "retail")
    return rd.discover_sources(spark, path.rsplit("/", 1)[0])


@register("ingest_csv", osql.with_raw("SELECT * FROM raw_retail"))
def _ingest_csv(spark, sf_dir):
    path, _ = _raw_path(spark, sf_dir, "retail")
    return rd.read_csv(spark, path, RAW_SCHEMAS["retail"])


@register("ingest_csv_sampled", osql.with_raw("""
SELECT * EXCLUDE (units_ordered, late), CASE WHEN late THEN NULL ELSE units_ordered END AS units_ordered, late AS misfit
FROM (SELECT *, CAST(transaction_id AS BIGINT) > 0.9 * max(CAST(transaction_id AS BIGINT)) OVER ()
        AND units_ordered % 7 = 3 AS late
      FROM (SELECT * REPLACE (CAST(transaction_id AS BIGINT) AS transaction_id, CAST(consumer_id AS BIGINT) AS consumer_id,
                              CAST(sku AS BIGINT) AS sku) FROM raw_retail) r) l"""))
def _ingest_csv_sampled(spark, sf_dir):
    """A CSV source without a declared schema: typed by its first 10,000 rows,
    every later row that does not fit marked."""
    df = rd.read_csv_sampled(spark, raw_files.late_misfit_folder(Layers(spark, sf_dir)))
    return df.withColumn("misfit", F.col(rd.CORRUPT).isNotNull()).drop(rd.CORRUPT)


@register("ingest_json_mixed", osql.with_raw("""
SELECT * REPLACE (CASE WHEN qty % 11 = 4 THEN NULL ELSE amount END AS amount,
                  CASE WHEN qty % 7 = 3 THEN NULL ELSE sold END AS sold),
  concat_ws(' ', CASE WHEN qty % 11 = 4 THEN 'amount' END, CASE WHEN qty % 7 = 3 THEN 'sold' END) AS misfits
FROM raw_app"""))
def _ingest_json_mixed(spark, sf_dir):
    """JSON arrays with cells of other types than declared, and which they are."""
    df = rd.read_json_array_variant(spark, raw_files.mixed_json_folder(Layers(spark, sf_dir)), RAW_SCHEMAS["app"])
    return df.withColumn("misfits", F.array_join(rd.MISFITS, " ")).drop(rd.MISFITS)


@register("ingest_ndjson", osql.with_raw("SELECT * FROM raw_ecomm_flat"))
def _ingest_ndjson(spark, sf_dir):
    path, _ = _raw_path(spark, sf_dir, "ecomm")
    return conf.flatten_lines(rd.read_ndjson(spark, path, RAW_SCHEMAS["ecomm"]), "lines")


@register("ingest_json_array", osql.with_raw("SELECT * FROM raw_app"))
def _ingest_json_array(spark, sf_dir):
    path, _ = _raw_path(spark, sf_dir, "app")
    return rd.read_json_array(spark, path, RAW_SCHEMAS["app"])


@register("ingest_parquet", osql.with_raw("SELECT * FROM raw_wholesale"))
def _ingest_parquet(spark, sf_dir):
    path, _ = _raw_path(spark, sf_dir, "wholesale")
    return rd.read_parquet(spark, path, RAW_SCHEMAS["wholesale"])


@register("ingest_xlsx", osql.with_raw("SELECT * FROM raw_franchise"))
def _ingest_xlsx(spark, sf_dir):
    path, _ = _raw_path(spark, sf_dir, "franchise")
    return rd.read_workbook(spark, path, RAW_SCHEMAS["franchise"])


_BRONZE_COUNTS = [("retail_orders.csv", "raw_retail"),
                  ("ecomm_orders.ndjson", "(SELECT DISTINCT orderId, customerId, market, period, "
                   "currency, adiClub, status FROM raw_ecomm_flat)"),
                  ("app_orders.json", "raw_app"), ("wholesale_orders.parquet", "raw_wholesale"),
                  ("franchise_orders.xlsx", "raw_franchise"), ("currency_reference.csv", "rates")]


@register("bronze_provenance", osql.with_raw("\nUNION ALL\n".join(
    f"SELECT '{f}' AS _source, count(*) AS n_rows FROM {src} s" for f, src in _BRONZE_COUNTS)))
def _bronze_provenance(spark, sf_dir):
    frames = _bronze(spark, sf_dir)
    return prof.union_all([df.groupBy("_source").agg(F.count(F.lit(1)).alias("n_rows"))
                           for _, df in sorted(frames.items())])


@register("bronze_part_files", osql.with_raw("""
SELECT 'retail_orders.csv' AS source, 'order_month=' || order_month AS folder, count(*) AS n_rows, TRUE AS dated
FROM raw_retail GROUP BY order_month
UNION ALL SELECT 'ecomm_orders.ndjson', 'period=' || CAST(period AS VARCHAR), count(*), TRUE
FROM (SELECT DISTINCT orderId, customerId, market, period, currency, adiClub, status FROM raw_ecomm_flat) o GROUP BY period
UNION ALL SELECT 'wholesale_orders.parquet', 'country_code=' || country_code, count(*), TRUE
FROM raw_wholesale GROUP BY country_code"""))
def _bronze_part_files(spark, sf_dir):
    """Rows read from the part files of each folder of three sources, and whether
    every file has a size and a time."""
    layers = Layers(spark, sf_dir)
    base = raw_files.foldered(layers)
    parts = []
    for source, (suffix, _) in raw_files.FOLDERED.items():
        entry = f"{source}_orders{suffix}"
        parts.append(ing.part_files(spark, f"{base}/{entry}", suffix, RAW_SCHEMAS[source])
                     .select(F.lit(entry).alias("source"), "*"))
    return (prof.union_all(parts)
            .groupBy("source", F.regexp_extract("_part", "([^/]+)/[^/]+$", 1).alias("folder"))
            .agg(F.sum("n_rows").alias("n_rows"),
                 F.bool_and((F.col("_part_bytes") > 0) & F.col("_part_modified").isNotNull()).alias("dated")))


# bronze width = the declared raw columns + the two provenance columns
_BRONZE_WIDTH = {(f"{k}_orders" if k != "currency_reference" else k): len(raw.schema_columns(ddl)) + 2
                 for k, ddl in RAW_SCHEMAS.items()}


@register("bronze_summary", osql.with_raw("\nUNION ALL\n".join(
    f"SELECT '{f.rsplit('.', 1)[0]}' AS source, count(*) AS n_rows, "
    f"{_BRONZE_WIDTH[f.rsplit('.', 1)[0]]} AS n_columns FROM {src} s" for f, src in _BRONZE_COUNTS)))
def _bronze_summary(spark, sf_dir):
    return ing.bronze_summary(_bronze(spark, sf_dir))


@register("bronze_ingest", osql.with_raw("SELECT *, 'retail_orders.csv' AS _source FROM raw_retail"))
def _bronze_ingest(spark, sf_dir):
    """One ingested source; the time of the ingestion differs by run."""
    return _bronze(spark, sf_dir)["retail_orders"].drop("_ingested_at")


@register("silver_from_files", osql.with_base(osql.CONFORMED_CTE_BODY))
def _silver_from_files(spark, sf_dir):
    return conf.build_fact_orders(_bronze(spark, sf_dir))


@register("gold_from_files", osql.kpi_joined_sql(["country", "year_month"]))
def _gold_from_files(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    fact = conf.build_fact_orders(bronze)
    fact_eur = fx.convert_to_eur(fact, bronze["currency_reference"])
    return present_kpis(kpis.build_kpi_table(fact_eur, ["country", "year_month"]))


@register("wholesale_summary", osql.with_base("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, "
    f"min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max FROM fact_eur "
    f"WHERE channel = 'wholesale'"
    for c in ["qty_sold", "unit_price", "unit_price_eur", "revenue_eur"])))
def _wholesale_summary(spark, sf_dir):
    """Cross-channel check, wholesale part: summary of the converted values."""
    fact = Layers(spark, sf_dir).fact_eur().filter(F.col("channel") == "wholesale")
    out = prof.describe_numeric(fact, ["qty_sold", "unit_price", "unit_price_eur", "revenue_eur"])
    return present(out, money=["mean", "std"])


RATE_PROFILE_COLS = ["country", "year_month", "currency_from", "currency_to"]


@register("profile_rates", osql.with_base(f"""
SELECT column_name, value, value_rank, n_distinct FROM (
  SELECT column_name, value,
    row_number() OVER (PARTITION BY column_name ORDER BY value ASC NULLS FIRST) AS value_rank,
    count(*) OVER (PARTITION BY column_name) AS n_distinct
  FROM ({_distinct_pairs_sql(RATE_PROFILE_COLS, 'rates')}) p
) r WHERE value_rank <= 15"""))
def _profile_rates(spark, sf_dir):
    """Rate-table check as printed by the source system: the countries, month
    format and currency codes present (with counts of distinct values)."""
    out = prof.profile_distinct(Layers(spark, sf_dir).rates(), RATE_PROFILE_COLS, n=15)
    return out.withColumn("value_rank", F.col("value_rank").cast("bigint"))


@register("describe_quartiles_exact", osql.with_base("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, "
    f"quantile_disc(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_disc(CAST({c} AS DOUBLE), 0.5) AS p50, "
    f"quantile_disc(CAST({c} AS DOUBLE), 0.75) AS p75 FROM fact_eur"
    for c in NUMERIC_FACT_COLS)))
def _describe_quartiles_exact(spark, sf_dir):
    """Exact quartiles of the numeric fact columns (distributed rank selection)."""
    return prof.exact_quantiles(spark, Layers(spark, sf_dir).fact_eur(), NUMERIC_FACT_COLS)


def _describe_all_sql() -> str:
    def nearest(c, p):
        return (f"(SELECT v FROM (SELECT CAST({c} AS DOUBLE) AS v, row_number() OVER (ORDER BY {c}) AS k, "
                f"count(*) OVER () AS n FROM fact_eur WHERE {c} IS NOT NULL) WHERE k = floor({p} * (n - 1) + 0.5) + 1)")
    numbers = [f"SELECT '{c}' AS column_name, count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
               f"round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, "
               f"min(CAST({c} AS DOUBLE)) AS min, {nearest(c, 0.25)} AS p25, {nearest(c, 0.5)} AS p50, "
               f"{nearest(c, 0.75)} AS p75, max(CAST({c} AS DOUBLE)) AS max, NULL AS min_text, NULL AS max_text FROM fact_eur"
               for c in NUMERIC_FACT_COLS]
    texts = [f"SELECT '{c}', count({c}), count(*) FILTER (WHERE {c} IS NULL), NULL, NULL, NULL, NULL, NULL, NULL, NULL, "
             f"min(CAST({c} AS VARCHAR)), max(CAST({c} AS VARCHAR)) FROM fact_eur"
             for c, _ in FACT_EUR_TYPES if c not in NUMERIC_FACT_COLS]
    return "\nUNION ALL\n".join(numbers + texts)


@register("describe_all", osql.with_base(_describe_all_sql()))
def _describe_all(spark, sf_dir):
    return present(prof.describe_all(spark, Layers(spark, sf_dir).fact_eur()), money=["mean", "std"])


def _sample_raw_key(channel: str):
    names = [c for c, _ in raw.schema_columns(RAW_SCHEMAS[channel])]

    @register(f"sample_raw_{channel}", osql.with_raw(
        f"SELECT {', '.join(names)} FROM raw_{channel} ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in names) + " LIMIT 5"))
    def q(spark, sf_dir):
        """First rows of one ingested raw source, in the order of its columns."""
        return prof.sample_rows(_bronze(spark, sf_dir)[f"{channel}_orders"].select(*names), 5)
    return q


for _ch in ("retail", "app", "wholesale", "franchise"):
    _sample_raw_key(_ch)


_BRONZE_SOURCES = [
    ("app_orders", "app", "raw_app"),
    ("currency_reference", "currency_reference", "rates"),
    ("ecomm_orders", "ecomm", "(SELECT DISTINCT orderId, customerId, market, period, currency, "
                              "adiClub, status, 0 AS lines FROM raw_ecomm_flat)"),
    ("franchise_orders", "franchise", "raw_franchise"),
    ("retail_orders", "retail", "raw_retail"),
    ("wholesale_orders", "wholesale", "raw_wholesale"),
]


def _profile_bronze_sql() -> str:
    parts = []
    for source, key, table in _BRONZE_SOURCES:
        cols = raw.schema_columns(RAW_SCHEMAS[key]) + [("_source", "string"), ("_ingested_at", "string")]
        for i, (c, t) in enumerate(cols, 1):
            nulls = "0" if c.startswith("_") or c == "lines" else f"count(*) FILTER (WHERE {c} IS NULL)"
            parts.append(f"SELECT '{source}' AS source, count(*) AS n_rows, {i} AS position, "
                         f"'{c}' AS column_name, '{t}' AS data_type, CAST({nulls} AS BIGINT) AS null_count "
                         f"FROM {table} s")
    return osql.with_raw("\nUNION ALL\n".join(parts))


@register("profile_bronze", _profile_bronze_sql())
def _profile_bronze(spark, sf_dir):
    """Source profile of every ingested raw source: rows, schema, nulls."""
    frames = _bronze(spark, sf_dir)
    return prof.union_all([prof.profile_source(df, name) for name, df in sorted(frames.items())])


# Columns inspected per raw source in the exploration step (fixed values).
RAW_PROFILE_COLUMNS = {
    "retail": ["store_country", "order_month", "currency", "loyalty_flag", "order_state"],
    "ecomm": ["market", "period", "currency", "adiClub", "status"],
    "app": ["cc", "yearmonth", "category", "currency", "member", "fulfillment"],
    "wholesale": ["country_code", "category_code", "currency", "status"],
    "franchise": ["Pais", "Mes", "Moneda", "AdiClub", "Estado_Orden"],
}


def _profile_raw_sql() -> str:
    parts = []
    for ch, cols in RAW_PROFILE_COLUMNS.items():
        table = "raw_ecomm_flat" if ch == "ecomm" else f"raw_{ch}"
        pairs = "\nUNION ALL\n".join(
            f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {table}" for c in cols)
        parts.append(f"""
SELECT '{ch}' AS source, column_name, value, value_rank, n_distinct FROM (
  SELECT column_name, value,
    row_number() OVER (PARTITION BY column_name ORDER BY value ASC NULLS FIRST) AS value_rank,
    count(*) OVER (PARTITION BY column_name) AS n_distinct
  FROM ({pairs}) p
) r WHERE value_rank <= 15""")
    return osql.with_raw("\nUNION ALL\n".join(parts))


@register("profile_distinct_raw", _profile_raw_sql())
def _profile_distinct_raw(spark, sf_dir):
    """Distinct-value profile of each raw source's coded columns (how the
    typos, dialects and codes were found), up to 15 example values each."""
    frames = []
    for ch, cols in RAW_PROFILE_COLUMNS.items():
        src = ecomm_lines(spark, sf_dir) if ch == "ecomm" else raw_frame(spark, sf_dir, ch)
        out = prof.profile_distinct(src, cols, n=15)
        frames.append(out.select(F.lit(ch).alias("source"), "column_name", "value",
                                 F.col("value_rank").cast("bigint").alias("value_rank"), "n_distinct"))
    return prof.union_all(frames)


@register("member_nulls_by_channel", osql.with_base("""
SELECT channel, count(*) FILTER (WHERE member IS NULL) AS member_nulls, count(*) AS n_lines
FROM fact GROUP BY channel"""))
def _member_nulls_by_channel(spark, sf_dir):
    """Known versus unknown member flag per channel (which channels can enter
    the loyalty comparison)."""
    return (Layers(spark, sf_dir).fact().groupBy("channel")
            .agg(F.count_if(F.col("member").isNull()).alias("member_nulls"),
                 F.count(F.lit(1)).alias("n_lines")))
