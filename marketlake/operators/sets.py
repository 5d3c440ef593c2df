"""Batch assembly (SET-1, SET-2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(frames: list[DataFrame], tag_col: str | None = None,
                  tags: list[str] | None = None) -> DataFrame:
    """SET-1: bag union of per-source batches by column name; a column a
    source lacks is null there.  Optionally tag each row with its source."""
    if tag_col:
        frames = [f.withColumn(tag_col, F.lit(t)) for f, t in zip(frames, tags)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _capped_days(batches: DataFrame, cap: int, run_date_col: str, zone_col: str, full_zone: int,
                 half_zones: tuple) -> DataFrame:
    """Per run date: rows of the full-day request, whether every half landed, halves at the cap."""
    half = {z: F.count_if(F.col(zone_col) == z) for z in half_zones}
    landed, at_cap = F.lit(0), F.lit(0)
    for n in half.values():
        landed, at_cap = landed + (n > 0).cast("int"), at_cap + (n >= cap).cast("int")
    return (batches.where(F.col(run_date_col).isNotNull()).groupBy(run_date_col)
            .agg(F.count_if(F.col(zone_col) == full_zone).alias("_full_n"),
                 landed.alias("_landed"), at_cap.alias("_at_cap")))


def assemble_capped(batches: DataFrame, cap: int, run_date_col: str = "run_date",
                    zone_col: str = "zone", full_zone: int = 1, half_zones: tuple = (2, 3)) -> DataFrame:
    """SET-2: choose, per run date, the full-day batch or its split halves — and never lose a day.

    A vendor returns at most ``cap`` rows per request.  ``batches`` holds the
    full-day request (``zone = full_zone``) and the narrower requests
    (``half_zones``) of each run date:

    * a full day below the cap is complete and kept alone;
    * a full day at the cap (``>= cap``) is truncated: the halves are kept
      instead, if every one of them landed;
    * otherwise all that landed is kept (a truncated full day without halves,
      halves without a full day); rows that are in both fall to the next
      insert-if-new, and :func:`capped_report` names the day.

    Rows without a run date belong to no day: :func:`capped_quarantine`.
    The per-day counts are a grouped aggregate (one row per calendar day of a
    DATE column, which bounds the broadcast), so a hot day stays spread out.
    """
    if dict(batches.dtypes)[run_date_col] != "date":
        raise ValueError(f"{run_date_col} must be a date")
    days = _capped_days(batches, cap, run_date_col, zone_col, full_zone, half_zones)
    tagged = batches.join(F.broadcast(days), run_date_col)
    is_full = F.col(zone_col) == full_zone
    complete = (F.col("_full_n") > 0) & (F.col("_full_n") < cap)
    halves = F.col("_landed") == len(half_zones)
    keep = F.when(complete, is_full).when(halves, ~is_full).otherwise(F.lit(True))
    return tagged.where(keep).select(*batches.columns)


def capped_report(batches: DataFrame, cap: int, run_date_col: str = "run_date",
                  zone_col: str = "zone", full_zone: int = 1, half_zones: tuple = (2, 3)) -> DataFrame:
    """Run dates whose batch may be incomplete: ``(run_date, reason)``."""
    days = _capped_days(batches, cap, run_date_col, zone_col, full_zone, half_zones)
    full, n = F.col("_full_n"), len(half_zones)
    reason = (F.when((full >= cap) & (F.col("_landed") < n), F.lit("full day at the cap, halves missing"))
              .when((full >= cap) & (F.col("_at_cap") > 0), F.lit("a half at the cap"))
              .when((full == 0) & (F.col("_landed") < n), F.lit("no full day, halves missing"))
              .when((full == 0) & (F.col("_at_cap") > 0), F.lit("a half at the cap")))
    return days.select(run_date_col, reason.alias("reason")).where(F.col("reason").isNotNull())


def capped_quarantine(batches: DataFrame, run_date_col: str = "run_date") -> DataFrame:
    """Rows that no run date claims."""
    return batches.where(F.col(run_date_col).isNull()).withColumn("reason", F.lit("null run date"))
