"""Rule results by row: every row carries the rules it fails as a bit mask, and
one write splits a table into its accepted and its quarantined part."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from chanfold.operators.fx import RATE_COL, RATE_KEYS
from chanfold.operators.quality import MONTH_PATTERN
from chanfold.session import open_folders

MASK, VERDICT = "failed_mask", "verdict"
ACCEPTED, QUARANTINED = "accepted", "quarantined"


def _bit(i: int) -> Column:
    return F.lit(1 << i).cast("bigint")


def mark_failures(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with ``failed_mask``: bit i is set where the predicate of rule i (in
    the order of ``rules``) is true; a null predicate is no violation."""
    if not 0 < len(rules) < 63:
        raise ValueError("1 to 62 rules fit a mask")
    clash = {MASK, VERDICT} & set(df.columns)
    if clash:
        raise ValueError(f"the table has columns of the result: {sorted(clash)}")
    bits = [F.when(p, _bit(i)).otherwise(_bit(i) * 0) for i, p in enumerate(rules.values())]
    return df.withColumn(MASK, reduce(lambda a, b: a.bitwiseOR(b), bits))


def failed_names(rules, mask: str = MASK) -> Column:
    """Names of the rules in a mask, in the order of the rules."""
    return F.array_compact(F.array(*[F.when(F.col(mask).bitwiseAND(_bit(i)) != 0, F.lit(name))
                                     for i, name in enumerate(rules)]))


def write_split(df: DataFrame, rules: dict[str, Column], folder: str) -> None:
    """Write every row of ``df`` once under ``folder``: ``rows/verdict=accepted``
    (no rule failed) and ``rows/verdict=quarantined`` (with their masks), and
    ``rules``, the violations of each rule.

    The violations are observed by the job that writes the rows, so the table is
    computed and read once.  Observed values come from the tasks whose output was
    committed, once each, so a task that ran twice does not count twice."""
    seen = Observation()
    counts = [F.count_if(F.col(MASK).bitwiseAND(_bit(i)) != 0).alias(f"r{i}") for i in range(len(rules))]
    rows = (mark_failures(df, rules).observe(seen, F.count(F.lit(1)).alias("n_rows"), *counts)
            .withColumn(VERDICT, F.when(F.col(MASK) == 0, ACCEPTED).otherwise(QUARANTINED)))
    with open_folders(df.sparkSession, 2):
        rows.write.partitionBy(VERDICT).parquet(f"{folder}/rows")
    got = seen.get
    (df.sparkSession.createDataFrame([(name, int(got.get(f"r{i}", 0))) for i, name in enumerate(rules)],
                                     "rule string, violations bigint")
     .coalesce(1).write.parquet(f"{folder}/rules"))


def read_split(spark: SparkSession, folder: str, schema: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted, quarantined, violations by rule) of a written split; ``schema``
    is that of the rows (needed where no row was written).  The two parts are
    folders, so each is read without the other; only the second has masks."""
    rows = spark.read.schema(f"{schema}, {MASK} bigint, {VERDICT} string").parquet(f"{folder}/rows")
    return (rows.where(F.col(VERDICT) == ACCEPTED).drop(VERDICT, MASK),
            rows.where(F.col(VERDICT) == QUARANTINED).drop(VERDICT),
            spark.read.schema("rule string, violations bigint").parquet(f"{folder}/rules"))


KEY_ROWS = "rows_of_key"


def with_key_rows(rates: DataFrame) -> DataFrame:
    """``rates`` with the number of rows of their (country, month), nulls equal
    to each other.  Only keys that repeat are joined, one row each, so a key that
    holds much of the table is split by rows of the left side."""
    renamed = {k: f"_{k}" for k in RATE_KEYS}
    repeated = (rates.groupBy(*RATE_KEYS).agg(F.count(F.lit(1)).alias(KEY_ROWS)).where(F.col(KEY_ROWS) > 1)
                .withColumnsRenamed(renamed))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(v)) for k, v in renamed.items()])
    return rates.join(repeated, same, "left").select(
        *rates.columns, F.coalesce(KEY_ROWS, F.lit(1)).cast("bigint").alias(KEY_ROWS))


def rate_rules() -> dict[str, Column]:
    """Rule name -> predicate over ``with_key_rows``, as ``fx.validate_rates``
    counts them, but a repeated key marks each of its rows."""
    return {
        "duplicate_keys": F.col(KEY_ROWS) > 1,
        "non_positive_rate": F.col(RATE_COL).isNull() | (F.col(RATE_COL) <= 0),
        "bad_month_format": ~F.coalesce(F.col("year_month").rlike(MONTH_PATTERN), F.lit(False)),
        "null_country": F.col("country").isNull(),
        "currency_to_not_eur": ~F.coalesce(F.col("currency_to") == "EUR", F.lit(False)),
    }
