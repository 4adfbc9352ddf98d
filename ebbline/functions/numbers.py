"""Small numeric and text expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def revenue() -> Column:
    return F.col("quantity") * F.col("unit_price")


def no_nan(c: Column) -> Column:
    """NaN becomes null; ``c`` is a double."""
    return F.nanvl(c, F.lit(None).cast("double"))


def finite(c: Column) -> Column:
    """NaN and infinite values become null; ``c`` is a double."""
    return F.when(F.abs(no_nan(c)) < F.lit(float("inf")), c)


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def ratio_or_zero(num: Column, den: Column) -> Column:
    """``num / den``; 0 where the denominator is 0 or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def null_if_zero(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("bigint"))


def bucket_index(value: Column, inner_edges: list[float]) -> Column:
    """Number of inner edges strictly below ``value`` (an equal value stays in the lower bucket)."""
    index = F.lit(0)
    for edge in inner_edges:
        index = index + F.when(value > F.lit(float(edge)), 1).otherwise(0)
    return F.when(value.isNotNull(), index)


def equal_width_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin of ``bins`` equal parts of ``[low, high]``; ``high`` falls into the last bin."""
    if high <= low:
        return F.when(value.isNotNull(), F.lit(0)).cast("bigint")
    raw = F.floor((value - F.lit(float(low))) / F.lit((high - low) / bins))
    # `least` skips nulls, so a missing value has to be kept out explicitly.
    return F.when(value.isNotNull(), F.least(raw, F.lit(bins - 1))).cast("bigint")


def _strip_zeros(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` refers to it."""
    return F.transform(F.array(value), then)[0]


def general_format(value: Column, digits: int = 6) -> Column:
    """Shortest text with ``digits`` significant digits, like C's ``%g``; null stays null."""
    # Exponent of the value once rounded to the wanted digits.
    exponent = lambda v: F.coalesce(F.regexp_extract(F.format_string(f"%.{digits - 1}e", v), r"e([+-]\d+)$", 1).try_cast("int"), F.lit(0))

    def rounded(v: Column, exponent: Column) -> Column:
        # The formatter rounds halves up; ties are settled half-even beforehand.
        even = v
        for e in range(-4, 16):
            even = F.when(exponent == e, F.bround(v, digits - 1 - e)).otherwise(even)
        return even

    def text(v: Column, exponent: Column, even: Column) -> Column:
        fixed = F.format_string(f"%.{digits - 1}f", v)
        for e in range(-4, digits):
            fixed = F.when(exponent == e, F.format_string(f"%.{digits - 1 - e}f", even)).otherwise(fixed)
        sci = F.format_string(f"%.{digits - 1}e", even)
        mantissa = _strip_zeros(F.regexp_extract(sci, r"^(.*)e", 1))
        scientific = F.concat(mantissa, F.lit("e"), F.regexp_extract(sci, r"e([+-]\d+)$", 1))
        out = F.when(exponent.between(-4, digits - 1), _strip_zeros(fixed)).otherwise(scientific)
        out = F.when(F.isnan(v), "nan").when(v == float("inf"), "inf").when(v == float("-inf"), "-inf").otherwise(out)
        return F.when(v.isNotNull(), out)

    return _bound(value, lambda v: _bound(exponent(v), lambda x: _bound(rounded(v, x), lambda even: text(v, x, even))))
