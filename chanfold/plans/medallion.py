"""Bronze -> silver -> gold as three write steps over a lake folder.

    lake/bronze/<source>.parquet      raw sources + provenance (one job each)
    lake/silver/fact_orders           conformed, EUR-converted fact, partitioned by channel
    lake/gold/<table>                 KPI cuts and loyalty tables

Each table is a folder of versions (``sources.versions``) and later layers read
the written files: a lost executor never forces a recompute of earlier layers,
and a run that fails leaves the tables of the run before readable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from chanfold.operators import conform, fx, kpis, loyalty
from chanfold.sources import ingest
from chanfold.sources.versions import replace_table

SILVER_PARTITIONS = ["channel"]

GOLD_TABLES = {
    "kpis_country_month": ["country", "year_month"],
    "kpis_channel_category": ["channel", "category"],
    "kpis_country_channel": ["country", "channel"],
}
MEMBER_TABLES = {
    "kpis_member": ["member"],
    "kpis_channel_member": ["channel", "member"],
}


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Parquet sink, optionally partitioned: replaces the table at ``path`` when
    the new version is whole; returns it re-read."""
    return replace_table(df, path, partition_by)


def build_bronze(spark: SparkSession, raw_dir: str, lake: str,
                 schemas: dict | None = None) -> dict[str, DataFrame]:
    return ingest.ingest_all(spark, raw_dir, f"{lake}/bronze", schemas)


def build_silver(spark: SparkSession, bronze: dict[str, DataFrame], lake: str,
                 rates_source: str = "currency_reference") -> tuple[DataFrame, Observation]:
    """Conform all channels, convert to EUR and write the silver fact once.
    The returned observation holds the number of rows without a rate,
    gathered by the same write job."""
    fact = conform.build_fact_orders(bronze)
    obs = Observation("fx_audit")
    fact_eur = fx.convert_to_eur(fact, bronze[rates_source], observation=obs)
    silver = write_parquet(fact_eur, f"{lake}/silver/fact_orders", SILVER_PARTITIONS)
    return silver, obs


def build_gold(spark: SparkSession, silver: DataFrame, lake: str) -> dict[str, DataFrame]:
    """All gold tables.  The KPI cuts are rolled up from one cube, which is
    written first so that every cut reads a small table instead of the fact."""
    cube = write_parquet(kpis.kpi_cube(silver), f"{lake}/gold/_kpi_cube")
    out = {}
    for name, cols in GOLD_TABLES.items():
        out[name] = write_parquet(kpis.rollup_cut(cube, cols), f"{lake}/gold/{name}")
    known = kpis.known_members(cube)
    for name, cols in MEMBER_TABLES.items():
        out[name] = write_parquet(kpis.rollup_cut(known, cols), f"{lake}/gold/{name}")
    comparison = loyalty.member_comparison(silver)
    out["kpis_member_comparison"] = write_parquet(comparison, f"{lake}/gold/kpis_member_comparison")
    out["kpis_member_by_channel"] = write_parquet(loyalty.member_orders_by_channel(silver),
                                                  f"{lake}/gold/kpis_member_by_channel")
    out["member_uplift"] = write_parquet(loyalty.member_uplift(out["kpis_member_comparison"]),
                                         f"{lake}/gold/member_uplift")
    return out


def run_all(spark: SparkSession, raw_dir: str, lake: str, schemas: dict | None = None) -> dict:
    bronze = build_bronze(spark, raw_dir, lake, schemas)
    silver, obs = build_silver(spark, bronze, lake)
    gold = build_gold(spark, silver, lake)
    return {"bronze": bronze, "silver": silver, "gold": gold,
            "missing_rate_rows": obs.get.get("missing_rate_rows")}
