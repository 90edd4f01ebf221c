"""Null, NaN and zero handling that Spark's ANSI mode does differently from
IEEE arithmetic (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chanfold.functions.recode import _as_col



def _nan() -> Column:
    return F.lit(float("nan"))


def _inf(sign: int = 1) -> Column:
    return F.lit(float("inf") if sign > 0 else float("-inf"))


def ieee_divide(num, den) -> Column:
    """``num / den`` with IEEE results for a zero divisor (0/0 -> NaN,
    x/0 -> +-inf) instead of an ANSI error.  Null in, null out."""
    num, den = _as_col(num).cast("double"), _as_col(den).cast("double")
    return (F.when(den.isNull() | num.isNull(), F.lit(None).cast("double"))
            .when(den != 0, num / den)
            .when(F.isnan(num) | (num == 0), _nan())
            .when(num > 0, _inf(1))
            .otherwise(_inf(-1)))


def nan_to_zero(c) -> Column:
    return F.nanvl(_as_col(c), F.lit(0.0))


def zero_if_null(c) -> Column:
    return F.coalesce(_as_col(c), F.lit(0.0))


def sum_or_zero(c) -> Column:
    """Sum where no (non-null) input gives 0 instead of Spark's null."""
    return F.coalesce(F.sum(_as_col(c)), F.lit(0).cast("double"))


# A plain sum of doubles depends on the order of addition, so it moves with the
# partitioning and decides rounding ties at random.  A money sum is therefore
# kept by binary exponent: an amount is cut into digits of 24 bits, for the
# powers of 2**24 from ``_LOW`` to ``_HIGH``, and each digit is summed as an
# integer, exactly.  Any double from about 1e-13 to 2.3e21 in size, and zero, is
# the sum of its digits.  The last part is what they leave: of smaller amounts the
# bits below 2**-96, and larger ones, NaN and infinities whole; it is summed as
# doubles.  All parts are additive, so sums of sums stay exact, and the total is
# rounded to a double once, to the nearest.
_BITS, _LOW, _HIGH = 24, -4, 2
_SIZE = float(1 << _BITS)
_BELOW = 2.0 ** (_BITS * (_HIGH + 1) - 1)
MONEY_PARTS = [*(f"digit{b - _LOW}" for b in range(_LOW, _HIGH + 1)), "rest"]


def money_parts(c) -> dict[str, Column]:
    """The parts of an amount by name (``MONEY_PARTS``), all null for null."""
    x = _as_col(c).cast("double")
    inside = F.abs(x) < F.lit(_BELOW)                  # false for NaN and infinities
    # The amount in units of 2**(24 * b), to the nearest; what one has beyond the
    # next is a digit.  Scaling and these differences are exact.
    units = {b: F.rint(x * F.lit(2.0 ** (-_BITS * b))) for b in range(_LOW, _HIGH + 2)}
    digits = [F.when(x.isNotNull(), F.when(inside, (units[b] - units[b + 1] * F.lit(_SIZE)).cast("bigint")).otherwise(0))
              for b in range(_LOW, _HIGH + 1)]
    left = x - units[_LOW] * F.lit(2.0 ** (_BITS * _LOW))
    return dict(zip(MONEY_PARTS, [*digits, F.when(inside, left).otherwise(x)]))


def _carried(digits: Column) -> Column:
    """struct(carry, own) of digits, lowest first, each brought to 0 .. 2**24 - 1."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("own"))
    return F.aggregate(digits, start, lambda acc, d: F.struct(
        F.shiftright(acc["carry"] + d, _BITS).alias("carry"),
        F.array_append(acc["own"], (acc["carry"] + d).bitwiseAND(F.lit((1 << _BITS) - 1))).alias("own")))


def _nearest(own: Column) -> Column:
    """The double nearest to a number of digits from 0 to 2**24 - 1, lowest first.

    Its first two digits that are not leading zeros make one double, the next
    two another, which holds half a unit more if any digit after them is not
    zero.  Both are exact, so their sum is rounded once, and rightly."""
    zero = F.lit(0.0)
    start = F.struct(F.lit(0).alias("n"), zero.alias("high"), zero.alias("low"), F.lit(0).alias("after"),
                     F.lit(False).alias("more"))

    def step(acc, d):
        n, x = acc["n"], d.cast("double")
        taken = (n > 0) | (d != 0)
        return F.struct(
            F.when(taken & (n < 4), n + 1).otherwise(n).alias("n"),
            F.when(taken & (n < 2), acc["high"] * _SIZE + x).otherwise(acc["high"]).alias("high"),
            F.when((n == 2) | (n == 3), acc["low"] * _SIZE + x).otherwise(acc["low"]).alias("low"),
            F.when(n == 4, acc["after"] + 1).otherwise(acc["after"]).alias("after"),
            (acc["more"] | ((n == 4) & (d != 0))).alias("more"))

    def total(acc):
        low = acc["low"] + F.when(acc["more"], 0.5).otherwise(0.0)
        scale = F.array(*(F.lit(2.0 ** (_BITS * (k + _LOW - 4))) for k in range(16)))
        return (acc["high"] * F.lit(_SIZE * _SIZE) + low) * F.get(scale, acc["after"])

    below = F.array(*[F.lit(0).cast("bigint")] * 4)
    return F.aggregate(F.reverse(F.concat(below, own)), start, step, total)


def money_total(parts: dict[str, Column]) -> Column:
    """Double from the summed parts; null when there was no amount."""
    digits = [F.coalesce(_as_col(parts[name]), F.lit(0)).cast("bigint") for name in MONEY_PARTS[:-1]]
    above = [F.lit(0).cast("bigint")] * 2              # where carries end
    up, down = _carried(F.array(*digits, *above)), _carried(F.array(*(-d for d in digits), *above))
    exact = F.when(up["carry"] < 0, -_nearest(down["own"])).otherwise(_nearest(up["own"]))
    return exact + _as_col(parts["rest"])


def money_sum(c) -> Column:
    """Sum of a money column as a double (null when no value); NaN if one of
    the amounts is NaN."""
    return money_total({name: F.sum(part) for name, part in money_parts(c).items()})


def money_sum_or_zero(c) -> Column:
    return F.coalesce(money_sum(c), F.lit(0.0))


def n_unique(c, approx: bool = False, rsd: float = 0.01) -> Column:
    """Distinct count in which null counts as one more value.

    Exact by default (a two-phase aggregate shuffled on the value).  With
    ``approx`` a HyperLogLog++ sketch of relative error ``rsd`` is used
    instead: fixed-size state per group, no shuffle of the values."""
    c = _as_col(c)
    distinct = F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)
    return (distinct + F.max(F.when(c.isNull(), F.lit(1)).otherwise(F.lit(0)))).cast("bigint")


def guarded_divide(num, den) -> Column:
    """``num / den`` or null when the divisor is null or zero (used for
    currency rates: a zero rate must not produce inf)."""
    num, den = _as_col(num), _as_col(den)
    return F.when(den != 0, num / den)
