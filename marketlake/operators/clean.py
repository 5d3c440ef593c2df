"""Cleaning (FLT-1, FLT-2, AGG-7, PRJ-1/2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_incomplete_distinct(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """FLT-1 + AGG-7: keep complete rows (no null in any of ``cols``; an empty
    string is not null) and remove exact duplicates."""
    cols = cols or df.columns
    return df.select(*cols).na.drop(how="any").distinct()


def allowlist(df: DataFrame, col: str, allowed: list, **equals) -> DataFrame:
    """FLT-2: ``col`` in ``allowed`` and every ``name == value`` in ``equals``."""
    cond = F.col(col).isin(list(allowed))
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.where(cond)


def rename_fields(df: DataFrame, mapping: dict[str, str], keep_only: bool = True) -> DataFrame:
    """PRJ-1/PRJ-2: pick and rename fields (``{source: target}``) in one
    projection (``keep_only=False`` renames and keeps the other columns).
    Fields a file may lack are handled by reading with an explicit schema,
    which yields typed nulls."""
    if keep_only:
        return df.select(*[F.col(f"`{s}`").alias(t) for s, t in mapping.items()])
    return df.withColumnsRenamed(mapping)
