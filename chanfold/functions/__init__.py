"""Column -> Column building blocks (all JVM-side built-ins, no UDFs)."""

from chanfold.functions.arith import (ieee_divide, n_unique, nan_to_zero, sum_or_zero,
                                      zero_if_null, guarded_divide)
from chanfold.functions.months import (MONTH_PARSERS, month_from_int, month_from_slash,
                                       month_from_spanish, month_from_timestamp)
from chanfold.functions import recode as recode_mod  # noqa: F401  (module alias)
from chanfold.functions.recode import decode_flag, literal_map, lower_status, recode, recode_code

__all__ = [
    "ieee_divide", "n_unique", "nan_to_zero", "sum_or_zero", "zero_if_null", "guarded_divide",
    "MONTH_PARSERS", "month_from_int", "month_from_slash", "month_from_spanish",
    "month_from_timestamp", "decode_flag", "literal_map", "lower_status", "recode", "recode_code",
]
