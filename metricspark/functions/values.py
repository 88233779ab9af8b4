"""Kinds of sample values.

Spark's parquet writer replaces every NaN by one canonical pattern. The kind of a value is
therefore decided on ingest, before the first write, and stored beside it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bit patterns of the two marked NaNs.
STALE_BITS = 0x7FF0000000000002
NORMAL_NAN_BITS = 0x7FF8000000000001

VALUE, STALE, NORMAL_NAN, OTHER_NAN = "value", "stale", "normal_nan", "other_nan"


def raw_bits(value: Column) -> Column:
    """The 64 bits of a double as text of a long."""
    return F.reflect(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), value)


def sample_kind(value: Column) -> Column:
    """``value``, ``stale``, ``normal_nan`` or ``other_nan``. Only NaNs pay for the bit test."""
    bits = raw_bits(value)
    nan = (
        F.when(bits == str(STALE_BITS), STALE).when(bits == str(NORMAL_NAN_BITS), NORMAL_NAN).otherwise(OTHER_NAN)
    )
    return F.when(F.isnan(value), nan).when(value.isNotNull(), VALUE)


def is_stale_marker(kind: Column) -> Column:
    return kind == STALE


def is_normal_nan(kind: Column) -> Column:
    return kind == NORMAL_NAN


def widen(text: Column, integer: Column) -> Column:
    """A value text as a double: long text where ``integer``, else float text; null if neither."""
    long_value = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint")).cast("double")
    number = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
    lower = F.lower(text)
    float_value = (
        F.when(text.rlike(number), text.try_cast("double"))
        .when(lower.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
        .when(lower.isin("-inf", "-infinity"), F.lit(float("-inf")))
        .when(lower.isin("nan", "+nan", "-nan"), F.lit(float("nan")))
    )
    return F.when(integer, long_value).otherwise(float_value)
