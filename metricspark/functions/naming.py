"""Names for tables and view columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The longest name, and the column names every view already has.
MAX_NAME = 62
RESERVED_COLUMNS = ("time", "value", "series_id", "labels")
RESERVED_PREFIX = "label_"


def name_with_suffix(full: Column, suffix: Column) -> Column:
    """Cut ``full`` so that it and ``_suffix`` fill exactly the longest name."""
    keep = F.lit(MAX_NAME - 1) - F.length(suffix)
    return F.concat(full.substr(F.lit(1), keep), F.lit("_"), suffix)


def unique_name(full: Column, suffix: Column) -> Column:
    """``full`` itself if it is short enough, else cut and made unique by ``suffix``."""
    return F.when(F.length(full) < MAX_NAME, full).otherwise(name_with_suffix(full, suffix))


def view_key(key: Column) -> Column:
    """The key a view column is named after: reserved names get a prefix."""
    return F.when(key.isin(*RESERVED_COLUMNS), F.concat(F.lit(RESERVED_PREFIX), key)).otherwise(key)


def value_column_name(key: Column, key_id: Column) -> Column:
    return unique_name(key, key_id.cast("string"))


def id_column_name(key: Column, key_id: Column) -> Column:
    return unique_name(F.concat(key, F.lit("_id")), F.concat(key_id.cast("string"), F.lit("_id")))
