"""Month dialects -> canonical ``YYYY-MM`` text (Column -> Column).

Every function propagates null: a malformed input gives null, which the
validation step reports, instead of an ANSI runtime error.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chanfold.functions.recode import _as_col, recode
from chanfold.specs import SPANISH_MONTH_TO_NUM


def month_from_spanish(c) -> Column:
    """``Abr-2025`` -> ``2025-04``: split on ``-``; part 0 is recoded with the
    Spanish month dictionary (unmapped text passes through), part 1 is the
    year.  ``concat`` (not ``concat_ws``) so a missing part gives null."""
    parts = F.split(_as_col(c), "-")
    month = recode(F.get(parts, 0), SPANISH_MONTH_TO_NUM)
    year = F.get(parts, 1)
    return F.concat(year, F.lit("-"), month)


def month_from_int(c) -> Column:
    """202503 -> ``2025-03``."""
    text = _as_col(c).cast("string")
    return F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2))


def month_from_slash(c) -> Column:
    """``2025/03`` -> ``2025-03``; only the first ``/`` is replaced."""
    return F.regexp_replace(_as_col(c), r"^([^/]*)/", "$1-")


def month_from_timestamp(c) -> Column:
    """Timestamp -> ``YYYY-MM`` (session time zone is UTC)."""
    return F.date_format(_as_col(c), "yyyy-MM")


MONTH_PARSERS = {
    "iso": lambda c: _as_col(c).cast("string"),
    "spanish": month_from_spanish,
    "int": month_from_int,
    "slash": month_from_slash,
    "timestamp": month_from_timestamp,
}
