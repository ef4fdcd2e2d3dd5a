"""Numeric expressions: guarded casts, money rounding, non-finite cleanup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values reproducing what pandas.to_numeric accepts: a decimal number
# with optional exponent, with surrounding ASCII whitespace allowed, no
# overflow to infinity, and (written exponent - digits after the point) <= 308;
# or exactly "inf"/"infinity" (any case, optional sign, no surrounding
# whitespace). 'nan', '1,000', '1d' and '' are rejected.
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
MAX_DECIMAL_EXPONENT = 308
INF_TEXT = r"^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"
_EDGE_WS = "^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _parts(c):
    raw = _c(c).cast("string")
    stripped = F.regexp_replace(raw, _EDGE_WS, "")
    number = stripped.try_cast("double")
    frac_digits = F.length(F.regexp_extract(stripped, r"^[+-]?[0-9]*\.?([0-9]*)", 1))
    exp_text = F.regexp_extract(stripped, r"[eE]([+-]?[0-9]+)$", 1)
    exp_ok = F.coalesce(exp_text.try_cast("bigint") - frac_digits <= MAX_DECIMAL_EXPONENT,
                        exp_text.startswith("-"))  # an exponent too long for bigint: only negative passes
    is_number = stripped.rlike(NUMBER_TEXT) & (F.abs(number) != F.lit(float("inf"))) & \
        F.when(exp_text == "", F.lit(True)).otherwise(exp_ok)
    is_inf = raw.rlike(INF_TEXT)
    return raw, number, F.coalesce(is_number, F.lit(False)), F.coalesce(is_inf, F.lit(False))


def is_numeric_text(c) -> Column:
    """True when the text converts to a number the way pandas.to_numeric does."""
    _raw, _number, is_number, is_inf = _parts(c)
    return is_number | is_inf


def text_to_double(c) -> Column:
    """Convert checked text to DOUBLE; NULL for anything ``is_numeric_text`` rejects."""
    raw, number, is_number, is_inf = _parts(c)
    return F.when(is_number, number).when(is_inf, raw.try_cast("double"))


def to_int_code(c) -> Column:
    """Zero-padded code text to INT ('0018' -> 18); bad text -> NULL."""
    return _c(c).cast("string").try_cast("int")


def round_money(c, scale: int = 2) -> Column:
    """ROUND half away from zero of the value's shortest decimal text, rounded once, as DOUBLE. Values too large for a decimal
    (their spacing is far above ``scale``) and non-finite ones stay as they are."""
    x = _c(c)
    return F.coalesce(x.try_cast(f"decimal(38,{scale})").cast("double"), x.cast("double"))


def nonfinite_to_null(c) -> Column:
    """NaN, +inf and -inf become NULL."""
    x = _c(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)
