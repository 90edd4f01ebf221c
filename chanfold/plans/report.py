"""Presentation rules for reported tables.

Sums of doubles depend on the order of addition, which differs between
engines and between runs with a different partitioning; reported money is
therefore rounded to 4 decimals and ratios to 6.  The library functions
themselves return unrounded values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType

MONEY_SCALE = 4
RATIO_SCALE = 6


def round_half_away(c, scale: int):
    """Round a double to ``scale`` decimals, half away from zero, decided on
    the binary value: ``round(x * 10^s) / 10^s``.  ``F.round(x, s)`` decides
    ties on the shortest decimal text of ``x`` instead, which differs from the
    binary value exactly at the ties (e.g. 190648.79665 is stored as
    190648.796649999...)."""
    factor = F.lit(float(10 ** scale))
    return F.round(F.col(c) * factor, 0) / factor


def _round(df: DataFrame, c: str, scale: int):
    if isinstance(df.schema[c].dataType, DecimalType):
        return F.round(F.col(c), scale).cast("double")     # exact decimal rounding
    return round_half_away(c, scale)


def present(df: DataFrame, money: list[str] = (), ratios: list[str] = ()) -> DataFrame:
    """Reported form: money to 4 decimals, ratios to 6, all as doubles."""
    cols = {c: _round(df, c, MONEY_SCALE) for c in money}
    cols.update({c: _round(df, c, RATIO_SCALE) for c in ratios})
    return df.withColumns(cols) if cols else df


KPI_MONEY = ["revenue_bruto_eur"]
KPI_RATIOS = ["return_rate", "fulfillment_rate"]


def present_kpis(df: DataFrame) -> DataFrame:
    return present(df, KPI_MONEY, KPI_RATIOS)
