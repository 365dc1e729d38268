"""Nanosecond time handling: ISO-8601 strings with 9 fraction digits <-> epoch ns.

Spark timestamps hold microseconds, so acquisition times are kept as BIGINT
nanoseconds since the epoch and as strings; a microsecond TIMESTAMP is derived
only for windowing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?Z?$"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def iso_to_epoch_ns(col: Column) -> Column:
    """``2024-03-05T20:27:12.605729480Z`` -> epoch nanoseconds (BIGINT)."""
    whole = F.regexp_extract(col, _ISO, 1)
    frac = F.regexp_extract(col, _ISO, 2)
    # wall-clock arithmetic on TIMESTAMP_NTZ: independent of the session time zone
    seconds = F.timestamp_diff("SECOND", _epoch(), F.to_timestamp_ntz(whole, F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    nanos = F.when(frac == "", F.lit(0)).otherwise(F.rpad(frac, 9, "0").cast("long"))
    return F.when(col.isNull() | (whole == ""), F.lit(None).cast("long")).otherwise(
        seconds.cast("long") * F.lit(1_000_000_000) + nanos
    )


def epoch_ns_to_iso(col: Column) -> Column:
    """Epoch nanoseconds -> ISO-8601 with nine fraction digits and ``Z``."""
    secs = F.floor(col / F.lit(1_000_000_000))
    nanos = col - secs * F.lit(1_000_000_000)
    base = F.date_format(F.timestamp_add("SECOND", secs, _epoch()), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(base, F.lit("."), F.lpad(nanos.cast("string"), 9, "0"), F.lit("Z"))


def offset_ns(col: Column) -> Column:
    """Header ``hw_time_offset_ns``: blank or non-numeric -> NULL."""
    trimmed = F.trim(col)
    return F.when(trimmed.rlike(r"^[+-]?\d+$"), trimmed.cast("long"))


def system_start_ns(start: Column, offset: Column) -> Column:
    """Start time on the system clock: start + offset when the offset is set
    and non-zero; NULL start gives NULL."""
    base = iso_to_epoch_ns(start)
    return F.when(offset.isNotNull() & (offset != 0), base + offset).otherwise(base)


def absolute_ns(start_ns: Column, relative_s: Column) -> Column:
    """Absolute sample time: start (ns) + relative seconds x 1e9, rounded."""
    return start_ns + F.round(relative_s * F.lit(1e9)).cast("long")
