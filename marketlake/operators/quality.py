"""Data-quality checks (DQ-1..DQ-5).  Each returns the violating rows (or a
one-pass count table), so a job can quarantine them, fail, or report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _any(cols):
    return reduce(lambda a, b: a | b, cols)


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """DQ-1: rows with a null in any of ``cols``, with the offending columns
    listed in ``reason``."""
    flags = [F.when(F.col(c).isNull(), F.lit(c)) for c in cols]
    return (df.where(_any([F.col(c).isNull() for c in cols]))
            .withColumn("reason", F.concat(F.lit("null: "), F.concat_ws(",", *flags))))


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ-2: key values occurring more than once, with their count.

    Partial aggregation combines map-side, so a hot key costs one row per map
    partition in the shuffle."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def check_fk(child: DataFrame, parent: DataFrame, fk: list[str] | dict) -> DataFrame:
    """DQ-3: child rows whose non-null foreign key has no parent row."""
    mapping = dict(zip(fk, fk)) if isinstance(fk, (list, tuple)) else dict(fk)
    parent_keys = parent.select(*[F.col(p).alias(c) for c, p in mapping.items()])
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in mapping])
    return child.where(present).join(parent_keys, list(mapping), "left_anti")


def check_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """DQ-4: rows where a text column is longer than its declared width."""
    return df.where(_any([F.length(F.col(c)) > n for c, n in limits.items()]))


def profile(df: DataFrame, not_null: list[str] = (), limits: dict[str, int] | None = None
            ) -> DataFrame:
    """DQ-1 + DQ-4 counts in ONE scan: a row per (check, column, violations)."""
    limits = limits or {}
    aggs, labels = [], []
    for c in not_null:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"nn_{len(labels)}"))
        labels.append(("not_null", c))
    for c, n in limits.items():
        aggs.append(F.count_if(F.length(F.col(c)) > n).alias(f"nn_{len(labels)}"))
        labels.append((f"length<={n}", c))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{chk}', '{col}', nn_{i}" for i, (chk, col) in enumerate(labels))
    return wide.selectExpr(
        f"stack({len(labels)}, {stack}) as (check, column_name, violations)")


def quarantine(df: DataFrame, condition, reason: str) -> tuple[DataFrame, DataFrame]:
    """DQ-5: split rows into (good, bad + ``reason``) by a boolean condition."""
    cond = F.coalesce(condition, F.lit(False))
    return df.where(~cond), df.where(cond).withColumn("reason", F.lit(reason))
