"""Time helpers (FN-8..FN-15).

Vendor time text arrives in two shapes: epoch milliseconds as text (daily
bars) and ``YYYYMMDDTHHMMSS`` (news).  Both parse with ``try_*`` functions so
a malformed value becomes null (and is caught by a DQ check) instead of
failing the whole job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the vendor's publication-time text format.
COMPACT_TS_FORMAT = "yyyyMMdd'T'HHmmss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_compact_ts(c) -> Column:
    """FN-11: ``20250710T134500`` → timestamp (no zone)."""
    return F.try_to_timestamp(_c(c), F.lit(COMPACT_TS_FORMAT)).cast("timestamp_ntz")


def format_compact_ts(c) -> Column:
    """Inverse of :func:`parse_compact_ts`."""
    return F.date_format(_c(c), COMPACT_TS_FORMAT)


def epoch_ms_to_ts(c) -> Column:
    """FN-12: epoch milliseconds (number or text) → timestamp (no zone)."""
    ms = _c(c).try_cast("bigint")
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def ts_to_epoch_ms(c) -> Column:
    """Timestamp → epoch milliseconds (bigint), truncating micros."""
    return F.unix_millis(_c(c).cast("timestamp"))


def time_id(c) -> Column:
    """Surrogate key of a calendar day: ``yyyymmdd`` as an integer.

    Derived from the date itself, so any job can compute it without a lookup
    or a global sequence, and it sorts like the date (good for pruning)."""
    d = _c(c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(date_col) -> list[Column]:
    """FN-14: the dim_time attributes of a date column.

    English day and month names, quarter as text ("1".."4"), year as int.
    """
    d = _c(date_col).cast("date")
    return [
        time_id(d).alias("id"),
        d.alias("date"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.date_format(d, "MMMM").alias("month"),
        F.quarter(d).cast("string").alias("quarter"),
        F.year(d).cast("int").alias("year"),
    ]


def published_day(c) -> Column:
    """``yyyymmdd`` (int) of a ``YYYYMMDDTHHMMSS`` publication time — the
    partition of a news row; null when the whole text is no such time."""
    return time_id(parse_compact_ts(c))
