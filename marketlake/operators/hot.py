"""Hot keys: measured in one pass, and joins that never shuffle their rows (JON-2, JON-7, KEY-3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least this share of all rows is hot: at most 1 / share keys are.
HOT_SHARE = 0.01
_HASH = "_key_hash"


def _present(keys: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _candidates(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Hashes of all keys that may hold ``share`` of the rows or more: 2 / share rows at most.

    One frequent-items sketch per task over 8-byte hashes, merged: its size depends on ``share`` alone, and
    nothing but sketches is shuffled.  It is off by at most a tenth of ``share``, so half of it misses no hot key."""
    if not 0.001 <= share <= 1:  # the sketch tracks at most a million keys
        raise ValueError("share must lie between 0.001 and 1")
    items = int(2 / share)
    top = rows.where(_present(keys)).select(F.xxhash64(*keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {items}, {items * 20})").alias("top"), F.count(F.lit(1)).alias("n"))
    found = top.select(F.explode("top").alias("t"), "n")
    return found.where(F.col("t.count") >= F.col("n") * F.lit(share / 2)).select(F.col("t.item").alias(_HASH))


def _meets(rows: DataFrame, hot: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows whose key is (``left_semi``) or isn't (``left_anti``) among the hot ones."""
    return rows.where(_present(keys)).join(F.broadcast(hot), F.xxhash64(*keys) == hot[_HASH], how)


def heavy_keys(rows: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """The keys with at least ``share`` of the rows that have a key, and their exact number of ``rows``.

    The sketch names candidates, a second pass counts their rows (partial sums per task).  Rows with a null key
    part have no key; an empty table has no hot keys."""
    hot = _meets(rows, _candidates(rows, keys, share), keys, "left_semi")
    counts = hot.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    total = rows.where(_present(keys)).agg(F.count(F.lit(1)).alias("_n"))  # one row
    return counts.join(F.broadcast(total), F.col("rows") >= F.col("_n") * F.lit(share)).drop("_n")


def split_join(rows: DataFrame, dim: DataFrame, keys: list[str], how: str = "inner", share: float = HOT_SHARE) -> DataFrame:
    """``rows.join(dim, keys, how)`` for a dimension with one row per key, whatever share of ``rows`` a key holds.

    Rows of hot keys meet their dimension rows (2 / ``share`` at most, since keys are unique in ``dim``) in a
    broadcast join, where they lie; all other rows are joined as usual, and rows with a null key part, which
    match nothing, take no part in a join.  ``how``: inner, left, left_semi or left_anti.  Keys must have the same
    types on both sides.  ``rows`` is run for its keys, for the hot and for the other rows: write it down first
    where that is dear."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"split_join: how={how}")
    for k in keys:  # equal keys of different types have different hashes
        if rows.schema[k].dataType != dim.schema[k].dataType:
            raise ValueError(f"split_join: {k} is {rows.schema[k].dataType} and {dim.schema[k].dataType}")
    hot = _candidates(rows, keys, share)
    out = _meets(rows, hot, keys, "left_semi").join(F.broadcast(_meets(dim, hot, keys, "left_semi")), keys, how)
    out = out.unionByName(_meets(rows, hot, keys, "left_anti").join(dim, keys, how))
    if how in ("left", "left_anti"):
        out = out.unionByName(rows.where(~_present(keys)), allowMissingColumns=True)
    return out
