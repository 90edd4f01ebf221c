"""Dictionary recodes and flag decoding (Column -> Column)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: dict) -> Column:
    """A ``map<string,string>`` literal; folded into the plan as a constant."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def recode(c, mapping: dict) -> Column:
    """Dictionary recode where unmapped values pass through and null stays null."""
    c = _as_col(c)
    return F.coalesce(F.try_element_at(literal_map(mapping), c), c)


def recode_code(c, mapping: dict) -> Column:
    """Code -> label recode with a text result: the code is cast to text first,
    so numeric codes (1-4) and letter codes both work; unmapped codes remain as
    their text form."""
    return recode(_as_col(c).cast("string"), {str(k): v for k, v in mapping.items()})


def decode_flag(c, true_value: str, false_value: str | None) -> Column:
    """Three-valued flag: ``true_value`` -> true, ``false_value`` -> false,
    anything else (including null) -> null.  With ``false_value`` None the
    flag can only be true or null."""
    c = _as_col(c)
    out = F.when(c == F.lit(true_value), F.lit(True))
    if false_value is not None:
        out = out.when(c == F.lit(false_value), F.lit(False))
    return out.cast("boolean")


def lower_status(c) -> Column:
    return F.lower(_as_col(c))
