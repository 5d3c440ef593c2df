"""Set-based write semantics (MRG-1..4, JON-8..11, DQ-6).

Plain parquet tables have no MERGE; every operator here computes the rows to
write (or the full next snapshot) as a DataFrame, and the caller writes it to
a new location (:mod:`marketlake.sinks.writers`).  Nothing is done row by row
and nothing passes through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import distinct_from, row_hash
from .keys import latest_per_key


def _all(cols):
    return reduce(lambda a, b: a & b, cols)


def null_key_rows(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that can never be stored (a key part is null) — quarantine them."""
    return batch.where(~_all([F.col(k).isNotNull() for k in keys]))


def total_order(df: DataFrame, keys: list[str], order_by=None) -> list:
    """``order_by`` and then every other column: rows that still tie are equal, so a pick
    never depends on the order in which rows arrive."""
    order_by = list(order_by or [])
    named = {c for c in order_by if isinstance(c, str)}
    rest = []
    for f in df.schema.fields:
        if f.name not in keys and f.name not in named:
            orderable = not isinstance(f.dataType, (T.MapType, T.VariantType))
            rest.append(f.name if orderable else F.to_json(F.col(f.name)))
    return order_by + rest


def insert_new(target: DataFrame, batch: DataFrame, keys: list[str], order_by=None,
               dedupe_batch: bool = True, prune_on: str | None = None,
               descending: bool = True, touched=None) -> DataFrame:
    """MRG-3 (JON-8/9/10/11): the batch rows whose key is not yet in ``target``.

    * null key parts are removed (see :func:`null_key_rows`): a stored key is
      never null, so ``NOT IN`` and ``NOT EXISTS`` agree with this anti-join
      on every row that could be stored;
    * ``dedupe_batch`` keeps one row per key inside the batch (the first by
      ``order_by`` and then all other columns (:func:`total_order`): latest
      first, or earliest with ``descending=False`` — what a sequence of daily
      insert-only runs keeps); with ``False`` every copy
      of a new key is returned, as a plain ``NOT IN`` insert would do;
    * the anti-join is a ``left_anti`` equi-join on all key columns — never a
      tuple ``NOT IN``, which plans as a nested-loop join;
    * ``prune_on`` names a partition column that is part of the key (or a
      function of it): the target is restricted to the partitions the batch
      touches.  ``touched`` says which: a list of values (known up front,
      e.g. the run date — static pruning at planning, no extra pass), a
      DataFrame holding a superset of the values (semi join → dynamic
      partition pruning), or None for the batch's own distinct values.
    """
    batch = batch.where(_all([F.col(k).isNotNull() for k in keys]))
    if dedupe_batch:
        batch = latest_per_key(batch, keys, total_order(batch, keys, order_by) or keys,
                               descending=descending)
    existing = target.select(*keys)
    if prune_on and isinstance(touched, (list, tuple, set)):
        existing = existing.where(F.col(prune_on).isin(list(touched)))
    elif prune_on:
        # distinct partition values (days): bounded by the calendar → broadcast,
        # which also lets dynamic partition pruning skip untouched directories
        values = batch if touched is None else touched
        days = F.broadcast(values.select(prune_on).distinct())
        existing = existing.join(days, prune_on, "left_semi")
    return batch.join(existing, keys, "left_anti")


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order_by=None,
                  flag_col: str = "inserted") -> DataFrame:
    """MRG-2: ``INSERT … ON CONFLICT DO NOTHING`` as the next full table.

    Target rows are kept as they are (``flag_col`` false); new keys of the
    batch are appended (``flag_col`` true), one row per key.
    """
    new_rows = insert_new(target, batch, keys, order_by=order_by).select(*target.columns)
    return (target.withColumn(flag_col, F.lit(False))
            .unionByName(new_rows.withColumn(flag_col, F.lit(True))))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], cols: list[str],
           order_by: list | None, run_ts, hash_mode: str = "json", hash_col: str = "hash_row",
           time_col: str = "updated_time", action_col: str = "action") -> DataFrame:
    """MRG-1: change-detecting upsert, as the next full snapshot.

    ``target`` holds ``keys + cols + [hash_col, time_col]`` (plus any other
    columns, e.g. ``id``, which are carried for existing keys).  The batch is
    reduced to one row per key (the last by ``order_by``, then by all other
    columns, wins), fingerprinted,
    and full-outer-joined to the target on the keys.  Per key:

    * only in batch → ``inserted``, ``time_col = run_ts``;
    * in both and the fingerprint differs (null-safe) → ``updated``, every
      column from the batch, ``time_col = run_ts``;
    * in both, same fingerprint → ``unchanged``, target row untouched;
    * only in target → ``kept`` (never deleted).

    ``action_col`` doubles as the affected-rows report (DQ-6): group on it.
    """
    run_ts = F.lit(run_ts).cast("timestamp_ntz") if not hasattr(run_ts, "_jc") else run_ts
    extra = [c for c in target.columns if c not in keys + cols + [hash_col, time_col]]
    b = batch.where(_all([F.col(k).isNotNull() for k in keys]))
    b = latest_per_key(b, keys, total_order(b, keys, order_by) or keys)
    b = b.select(*keys, *cols, row_hash(cols, hash_mode).alias(hash_col))
    t = target.select(*keys, *cols, hash_col, time_col, *extra)
    tt = t.select(*[F.col(c).alias(f"t_{c}") for c in t.columns])
    bb = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    cond = _all([tt[f"t_{k}"] == bb[f"b_{k}"] for k in keys])
    j = tt.join(bb, cond, "full_outer")
    in_t = F.col(f"t_{keys[0]}").isNotNull()
    in_b = F.col(f"b_{keys[0]}").isNotNull()
    action = (F.when(~in_t, F.lit("inserted"))
              .when(~in_b, F.lit("kept"))
              .when(distinct_from(f"t_{hash_col}", f"b_{hash_col}"), F.lit("updated"))
              .otherwise(F.lit("unchanged")))
    j = j.withColumn(action_col, action)
    take_b = F.col(action_col).isin("inserted", "updated")
    out = [F.coalesce(F.col(f"b_{k}"), F.col(f"t_{k}")).alias(k) for k in keys]
    out += [F.when(take_b, F.col(f"b_{c}")).otherwise(F.col(f"t_{c}")).alias(c)
            for c in cols + [hash_col]]
    out += [F.when(take_b, run_ts).otherwise(F.col(f"t_{time_col}")).alias(time_col)]
    out += [F.col(f"t_{c}").alias(c) for c in extra]
    return j.select(*out, action_col)


def duplicate_count(batch: DataFrame, keys: list[str]) -> DataFrame:
    """DQ-6: how many batch rows lost to another row of their key (one row, ``rows``)."""
    per = batch.where(_all([F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows"))


def merge_report(merged: DataFrame, action_col: str = "action") -> DataFrame:
    """DQ-6: affected-row counts per action (inserted/updated/unchanged/kept)."""
    return merged.groupBy(action_col).agg(F.count(F.lit(1)).alias("rows"))
