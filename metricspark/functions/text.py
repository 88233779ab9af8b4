"""Small text and time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KIB = 1024
MIB = 1024 * 1024


def format_bytes(n: Column) -> Column:
    """``1.5 KiB`` or ``2.0 MiB``; MiB only above one MiB. Halves go to the even digit."""
    return F.when(n > MIB, F.format_string("%.1f MiB", F.bround(n / MIB, 1))).otherwise(
        F.format_string("%.1f KiB", F.bround(n / KIB, 1))
    )


def instant(ts: Column) -> Column:
    """A zone-less timestamp read as UTC, whatever the session time zone."""
    return F.timestamp_micros(micros_of(ts))


def micros_of(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("MICROSECOND", epoch, ts)


def escape_label_value(value: Column) -> Column:
    """A label value as exposition text holds it: backslash, quote and newline escaped."""
    escaped = value
    for raw, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(written))
    return escaped
