"""Keys: latest row per key, surrogate ids, foreign-key resolution
(WIN-1, FLT-10, AGG-8, KEY-1, KEY-2, KEY-3, JON-4, JON-5, DQ-5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import DAY_HASH_BITS, day_hash_id, hash_id, key_text
from ..session import materialise


def _order_cols(order_by, descending: bool) -> list[Column]:
    cols = []
    for c in order_by:
        c = F.col(c) if isinstance(c, str) else c
        cols.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    return cols


def latest_per_key(df: DataFrame, keys: list[str], order_by: list, descending: bool = True,
                   rank_col: str | None = None) -> DataFrame:
    """WIN-1 / FLT-10: one row per key, the first by ``order_by``.

    ``order_by`` must end in a column that is unique within a key so the pick
    is deterministic (arbitrary picks, AGG-8, become this with a tie-break).
    Default is the latest (descending, nulls last); ``descending=False`` gives
    the earliest occurrence (backfill: first run date wins).

    Plan: ``row_number() = 1`` lets Spark insert a partial WindowGroupLimit
    before the shuffle, so a hot key is cut to one row per map partition
    before it is exchanged — a key holding a third of the data does not land
    whole in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order_by, descending))
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1)
    return out if rank_col else out.drop(rn)


def assign_hash_ids(df: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """KEY-1 for large tables: ``xxhash64`` of the natural key (no sort, no
    single task).  Check uniqueness with :func:`quality.check_unique`."""
    return df.withColumn(id_col, hash_id(keys))


#: Columns of the map of keys whose id is not their hash.
ID_MAP = "kind string, day int, base long, key string, id long"


def settle_ids(rows: DataFrame, stored: DataFrame, keys: list[str], day_col: str, kind: str, bits: int = DAY_HASH_BITS,
               id_col: str = "id") -> tuple[DataFrame, DataFrame | None]:
    """KEY-1: unique :func:`day_hash_id` ids for new rows, whatever their hashes do.

    ``rows`` are new keys (unique, written, so read as often as needed), ``stored`` the rows that have ids already; only
    its days of the batch are read, and only (day, id).  Where ids meet, a stored row keeps its id, else the smallest key
    does; the others try one salt after the other.  Returns the rows and the map of those that moved (:data:`ID_MAP`; None
    as a rule), by which later loads find the id of a key.  Each round is one aggregate on (day, id) without a sort."""
    base = rows.withColumn(id_col, day_hash_id(keys, F.col(day_col), bits))
    days = F.broadcast(rows.select(day_col).distinct())  # one a calendar day
    taken = stored.select(day_col, id_col).join(days, day_col, "left_semi")
    done, todo, salt = [], base, 0
    while True:
        both = todo.select(day_col, id_col, F.lit(0).alias("_old")).unionByName(taken.select(day_col, id_col, F.lit(1).alias("_old")))
        for frame in done:
            both = both.unionByName(frame.select(day_col, id_col, F.lit(1).alias("_old")))
        met = both.groupBy(day_col, id_col).agg(F.count(F.lit(1)).alias("_n"), F.max("_old").alias("_held")).where("_n > 1")
        met = materialise(met.select(day_col, id_col, "_held"), "id-meetings")
        if met.isEmpty():
            done.append(todo)
            break
        rank = F.row_number().over(Window.partitionBy(day_col, id_col).orderBy(*keys))
        losers = todo.join(met, [day_col, id_col]).withColumn("_rank", rank).where("_held = 1 OR _rank > 1").drop("_held", "_rank")
        losers = materialise(losers, "id-losers")
        done.append(todo.join(losers.select(day_col, *keys), [day_col, *keys], "left_anti"))
        salt += 1
        if salt > 12:  # with 47 bits one round is rare, two are not to be seen
            raise ValueError(f"{kind}: too many rows a day for ids of {bits} hash bits")
        todo = losers.withColumn(id_col, day_hash_id(keys, F.col(day_col), bits, salt))
    out = reduce(lambda a, b: a.unionByName(b), [f.select(*rows.columns) for f in done])
    if not salt:
        return out, None
    moved = reduce(lambda a, b: a.unionByName(b), done[1:])
    return out, moved.select(F.lit(kind).alias("kind"), F.col(day_col).cast("int").alias("day"), day_hash_id(keys, F.col(day_col), bits).alias("base"),
                             key_text(keys).alias("key"), F.col(id_col).alias("id"))


def mapped_ids(df: DataFrame, keys: list[str], day_col: str, kind: str, alias: str, id_map: DataFrame | None = None,
               bits: int = DAY_HASH_BITS) -> DataFrame:
    """``df`` with the id of a key of another table: its hash, or what the map of moved keys says."""
    out = df.withColumn(alias, day_hash_id(keys, F.col(day_col), bits))
    if id_map is None:
        return out
    moved = id_map.where(F.col("kind") == kind).select(F.col("day").alias("_day"), F.col("base").alias("_base"), F.col("key").alias("_key"), F.col("id").alias("_id"))
    out = out.withColumn("_text", key_text(keys))
    cond = (F.col(day_col) == F.col("_day")) & (F.col(alias) == F.col("_base")) & (F.col("_text") == F.col("_key"))
    found = out.join(moved, cond, "left")  # the map is tiny; AQE broadcasts it by its measured size
    return found.withColumn(alias, F.coalesce("_id", alias)).drop("_day", "_base", "_key", "_id", "_text")


def assign_dense_ids(df: DataFrame, order_by: list[str], start=0, id_col: str = "id",
                     num_partitions: int | None = None) -> DataFrame:
    """KEY-1 for dimension rows: ids ``start+1, start+2, …`` in ``order_by``
    order, dense and gap-free, without pulling the rows into one task.

    The rows are range-partitioned on ``order_by`` and sorted within each
    partition; ``monotonically_increasing_id`` then gives each row its
    position inside its partition (documented layout: partition id in the
    upper 31 bits, record number in the lower 33).  A prefix sum over the
    per-partition counts (one row per partition — bounded by the partition
    count, so it is broadcast) shifts each partition's positions.
    ``order_by`` must be unique per row.  ``start`` is the target's current
    ``max(id)`` (a scalar; see :func:`max_id`).
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: partition ids and positions are assigned at run time, so
    # both branches below (counts, positions) must read the same rows, also
    # after losing an executor
    pid = F.spark_partition_id()
    ranged = materialise(df.repartitionByRange(n, *order_by)
                         .sortWithinPartitions(*order_by)
                         .withColumn("_pid", pid)
                         .withColumn("_pos", F.monotonically_increasing_id()
                                     - F.shiftleft(pid.cast("long"), 33)), "dense-ids")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    numbered = ranged.join(F.broadcast(offsets), "_pid")
    out = numbered.withColumn(
        id_col, (F.lit(int(start)) + F.col("_off") + F.col("_pos") + F.lit(1)).cast("long"))
    return out.drop("_pid", "_pos", "_off")


def resolve_fk(df: DataFrame, dim: DataFrame, on: list[str] | dict, id_col: str = "id",
               alias: str | None = None, bounded: bool = False,
               reason: str | None = None) -> tuple[DataFrame, DataFrame]:
    """JON-4/5 + DQ-5: attach the dimension id for a natural key.

    ``on`` is a list of shared column names or a mapping ``{df_col: dim_col}``
    (composite keys allowed).  Returns ``(matched, missed)``: matched rows
    carry ``alias`` (default ``id_col``); missed rows — unknown key or any
    null key part — carry a ``reason`` text and go to quarantine instead of
    silently failing the load.  ``dim`` keys must be unique (DQ-2).

    ``bounded=True`` broadcasts the dimension; only pass it for dimensions
    whose size is fixed by the domain (regions, exchanges, calendar).
    Otherwise AQE decides at run time from the measured size.  Rows with a null
    key part take no part in the join (they would all meet in one task).
    """
    mapping = dict(zip(on, on)) if isinstance(on, (list, tuple)) else dict(on)
    alias = alias or id_col
    keyed = dim.select(*[F.col(d).alias(f"_k_{s}") for s, d in mapping.items()],
                       F.col(id_col).alias(alias))
    if bounded:
        keyed = F.broadcast(keyed)
    cond = None
    for s in mapping:
        part = df[s] == keyed[f"_k_{s}"]
        cond = part if cond is None else cond & part
    null_key = reduce(lambda a, b: a | b, [F.col(s).isNull() for s in mapping])
    joined = df.where(~null_key).join(keyed, cond, "left")
    cols = df.columns
    matched = joined.where(F.col(alias).isNotNull()).select(*cols, alias)
    why = reason or ("unknown " + "/".join(mapping))
    missed = joined.where(F.col(alias).isNull()).select(*cols, F.lit(why).alias("reason"))
    no_key = df.where(null_key).select(*cols, F.lit("null " + "/".join(mapping)).alias("reason"))
    return matched, missed.unionByName(no_key)


def resolve_fks(df: DataFrame, lookups: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """Several foreign keys at once: ``lookups`` holds ``(dim, on, alias)`` as in
    :func:`resolve_fk` (``on`` a list or ``{df_col: dim_col}``).

    One left join per key, written once; returns ``(matched, missed)``, where
    missed rows carry the reason of the first key that did not resolve.  No
    side is forced into a broadcast: AQE decides from measured sizes.  Rows
    with a null key part take no part in that key's join (they would all meet
    in one task)."""
    cols, out, reason = df.columns, df, F.lit(None).cast("string")
    for dim, on, alias in reversed(lookups):
        mapping = dict(zip(on, on)) if isinstance(on, (list, tuple)) else dict(on)
        null_key = reduce(lambda a, b: a | b, [F.col(s).isNull() for s in mapping])
        why = F.when(null_key, F.lit("null " + "/".join(mapping))).otherwise(F.lit("unknown " + "/".join(mapping)))
        reason = F.when(F.col(alias).isNull(), why).otherwise(reason)
    for dim, on, alias in lookups:
        mapping = dict(zip(on, on)) if isinstance(on, (list, tuple)) else dict(on)
        keyed = dim.select(*[F.col(d).alias(f"_k_{s}") for s, d in mapping.items()], F.col("id").alias(alias))
        some = reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s in mapping])
        cond = reduce(lambda a, b: a & b, [F.col(s) == F.col(f"_k_{s}") for s in mapping])
        found = out.where(some).join(keyed, cond, "left").drop(*[f"_k_{s}" for s in mapping])
        out = found.unionByName(out.where(~some), allowMissingColumns=True)
    out = materialise(out.withColumn("reason", reason), "fk")
    return (out.where(F.col("reason").isNull()).drop("reason"),
            out.where(F.col("reason").isNotNull()).select(*cols, "reason"))


def latest_id_per_key(dim: DataFrame, key: str, order_by: list, id_col: str = "id") -> DataFrame:
    """KEY-3: map each natural key (ticker) to the id of its latest row."""
    return latest_per_key(dim.select(key, id_col, *[c for c in order_by if c not in (key, id_col)]),
                          [key], order_by).select(key, id_col)


def max_id(target: DataFrame, id_col: str = "id") -> int:
    """Current largest id of a table (0 when empty) — one scalar aggregate."""
    v = target.agg(F.max(id_col)).first()[0]
    return int(v or 0)
