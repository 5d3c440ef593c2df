"""Operator 3: near-duplicate vectors by cross-polytope hashing.

Vectors are rotated by random signs and a fast Hadamard transform, three times; the largest
coordinate and its sign are a hash, some hashes a bucket, and the runner-up coordinates are probed as
well.  Hashes per bucket grow with the largest label, so that buckets of unrelated vectors stay small, and tables are
added until pairs at the threshold are found with RECALL, as measured on random ones.  Vectors that share a bucket of
any table are compared in double precision, in blocks, and a pair is counted at the smallest bucket that both have.  A
block gives each vector's number of links and a spanning forest: links are never rows.  Equal vectors of one label are
one class, numbered once; classes, not ids, are what is linked, with the number of copies.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, materialise, tune
from marketlake.llm.components import components

#: Hash tables and hashes per bucket unless planned, and extra buckets probed in each table.
TABLES, HASHES, PROBES = 8, 2, 1
#: Share of pairs exactly at the threshold that must share a bucket, tables at most, and random pairs it is measured on.
RECALL, MOST_TABLES, TRIALS = 0.998, 24, 2000
#: Vectors that an average bucket of the largest label may hold.
CROWD = 2
#: Vectors of one side of a comparison block, and block rows that one group of blocks should hold.
BLOCK, GROUP_ROWS = 1024, 16384
#: Pairs compared at a time.
_PAIRS = 1 << 16


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row (a power of two long), scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def buckets(x: np.ndarray, seed: int = 11, tables: int = TABLES, hashes: int = HASHES) -> np.ndarray:
    """(rows, tables * (1 + PROBES)) bucket numbers: in each table the nearest, then probes by rising cost."""
    n, d = x.shape
    width = max(2, 1 << (d - 1).bit_length())
    x = np.concatenate([x, np.zeros((n, width - d))], 1)
    rng = np.random.Generator(np.random.PCG64([seed, d]))
    out = np.empty((n, tables, 1 + PROBES), np.int64)
    for t in range(tables):
        best, cost = [], []
        for _ in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width))
            two = np.sort(np.argpartition(-np.abs(y), 1, 1)[:, :2], 1) if width > 2 else np.tile([0, 1], (n, 1))
            v = np.take_along_axis(y, two, 1)
            order = np.argsort(-np.abs(v), 1, kind="stable")
            two, v = np.take_along_axis(two, order, 1), np.take_along_axis(v, order, 1)
            best.append(2 * two + (v < 0))
            cost.append(np.abs(v[:, 0]) - np.abs(v[:, 1]))
        # every choice of nearest or runner-up per hash, cheapest first
        choices = np.array([[(c >> k) & 1 for k in range(hashes)] for c in range(1 << hashes)])
        price = sum(choices[None, :, k] * cost[k][:, None] for k in range(hashes))
        for p, c in enumerate(np.argsort(price, 1, kind="stable")[:, :1 + PROBES].T):
            key = np.full(n, t, np.int64)
            for k in range(hashes):
                key = key * (2 * width) + best[k][np.arange(n), choices[c, k]]
            out[:, t, p] = key
    return out.reshape(n, -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows in double precision and of length one, without overflow or underflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def plan(d: int, n: int, cosine: float) -> tuple[int, int]:
    """(tables, hashes) for vectors of length d, of which the largest label has n: the most hashes, up to those that leave
    CROWD vectors a bucket, for which MOST_TABLES tables find RECALL of random pairs at the threshold, and the fewest such tables."""
    width = max(2, 1 << (d - 1).bit_length())
    rng = np.random.Generator(np.random.PCG64([17, d]))
    a, b = rng.normal(size=(2, TRIALS, d))
    a = unit(a)
    side = b - (a * b).sum(1, keepdims=True) * a
    if d > 1:
        b = unit(cosine * a + np.sqrt(max(0.0, 1 - cosine ** 2)) * unit(side))
    else:
        b = a
    best = (MOST_TABLES, 1)
    for hashes in range(1, 1 + max(1, math.ceil(math.log(max(2, n / CROWD)) / math.log(2 * width)))):
        x, y = (buckets(v, tables=MOST_TABLES, hashes=hashes).reshape(TRIALS, MOST_TABLES, -1) for v in (a, b))
        met = (x[:, :, :, None] == y[:, :, None, :]).any((2, 3))
        found = np.maximum.accumulate(met, 1).mean(0)
        if found[-1] < RECALL:
            break
        best = (int(np.argmax(found >= RECALL)) + 1, hashes)
    return best


def _hash_rows(dtype: type, plans: dict[int, tuple[int, int]]):
    schema = pa.schema([("rep", pa.int64()), ("d", pa.int32()), ("label", pa.string()), ("m", pa.int64()), ("keys", pa.list_(pa.int64())), ("v", pa.binary())])

    def run(batches):
        for b in batches:
            vectors = [np.asarray(v, dtype) for v in b.column(3).to_pylist()]
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_length.setdefault(len(v), []).append(i)
            for d, at in by_length.items():
                x = np.stack([vectors[i] for i in at])
                tables, hashes = plans[d]
                keys = list(buckets(unit(x), tables=tables, hashes=hashes))
                own = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array([d] * len(at), pa.int32()), own.column(1), own.column(2),
                                                  pa.array(keys, schema.field("keys").type), pa.array([r.tobytes() for r in x])], schema=schema)

    return run


def _pairs(side: np.ndarray, start: np.ndarray):
    """Arrays (i, j) of the pairs of blocks whose rows stand together (block k from ``start[k]`` on): side 0 with
    side 1, or all with all that come later where side is 2; at most about _PAIRS at a time."""
    held, n = [], 0
    for a, b in zip(start[:-1].tolist(), start[1:].tolist()):
        if side[a] == 2:
            i, j = np.triu_indices(b - a, 1)
        else:
            left, right = np.flatnonzero(side[a:b] == 0), np.flatnonzero(side[a:b] == 1)
            i, j = np.repeat(left, len(right)), np.tile(right, len(left))
        for k in range(0, len(i), _PAIRS):
            held.append((i[k:k + _PAIRS] + a, j[k:k + _PAIRS] + a))
            n += len(held[-1][0])
            if n >= _PAIRS:
                yield [np.concatenate(c) for c in zip(*held)]
                held, n = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number reachable from each of n by the links (i, j)."""
    low = np.arange(n)
    while True:
        before = low.copy()
        both = np.minimum(low[i], low[j])
        for at in (before[i], before[j], i, j):
            np.minimum.at(low, at, both)
        low = low[low]
        if (low == before).all():
            return low


def _compare(cosine: float, dtype: type):
    """Of a group of blocks: rows (a, null, links of a) and (a, b, 0), the edges of a spanning forest."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        place = pa.Table.from_arrays([t.column(c) for c in ("d", "label", "bucket", "x", "y")], names=list("dlbxy"))
        t = t.take(pa.compute.sort_indices(place, [(c, "ascending") for c in "dlbxy"]))
        d = t.column("d").to_numpy()
        label = t.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        columns = [label, d, *(t.column(c).to_numpy() for c in ("bucket", "x", "y"))]
        new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        start = np.concatenate([[0], np.flatnonzero(new) + 1, [t.num_rows]])
        side, rep, m, bucket = (t.column(c).to_numpy() for c in ("side", "rep", "m", "bucket"))
        vectors, keys = t.column("v").to_pylist(), t.column("keys").combine_chunks()
        out = [[], [], []]
        for length in np.unique(d):  # blocks are of one length each
            at = np.flatnonzero(d == length)
            x = unit(np.frombuffer(b"".join(vectors[r] for r in at.tolist()), dtype).reshape(len(at), -1))
            key = keys.take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
            own = np.append(start[:-1][d[start[:-1]] == length], at[-1] + 1) - at[0]
            links = [[], []]
            for i, j in _pairs(side[at], own):
                ok = (rep[at[i]] != rep[at[j]]) & ((x[i] * x[j]).sum(1) >= cosine)
                i, j = i[ok], j[ok]
                for k in range(0, len(i), 4096):  # the smallest bucket of both, whichever stands first
                    p, q = i[k:k + 4096], j[k:k + 4096]
                    shared = (key[p][:, :, None] == key[q][:, None, :]).any(2)
                    first = np.where(shared, key[p], np.iinfo(np.int64).max).min(1) == bucket[at[p]]
                    links[0].append(p[first])
                    links[1].append(q[first])
            i, j = (np.concatenate(c) if c else np.empty(0, np.int64) for c in links)
            names, code = np.unique(rep[at], return_inverse=True)
            i, j, copies = code[i], code[j], np.zeros(len(names), np.int64)
            copies[code] = m[at]
            n = np.zeros(len(names), np.int64)
            np.add.at(n, i, copies[j])
            np.add.at(n, j, copies[i])
            low = smallest_linked(len(names), i, j)
            linked, child = np.flatnonzero(n), np.flatnonzero(low != np.arange(len(names)))
            out[0] += [names[linked], names[child]]
            out[1] += [np.full(len(linked), -1), names[low[child]]]
            out[2] += [n[linked], np.zeros(len(child), np.int64)]
        cols = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        return pa.Table.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64(), mask=cols[1] < 0), pa.array(cols[2], pa.int64())], schema=schema)

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98) -> DataFrame:
    """One row per vector: n_links (others of its label with at least that cosine), component_id
    (smallest id reachable by links) and kept (it is that one).

    Vectors that are null, empty, zero or hold null or non-finite components, and those without a label,
    link with nothing.  Vectors of different lengths are never compared.  Vectors are linked, not ids: rows of one id with
    different vectors each have their own vector's links, whatever the order of rows.  A null id links with nothing,
    has no component and is kept; repeated rows count as further copies; an empty table gives no rows."""
    tune(vectors.sparkSession)
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.coalesce((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    rows = rows.select("id", "label", F.when(fine & F.col("label").isNotNull() & F.col("id").isNotNull(), F.col("v")).alias("v"))
    # -0.0 and 0.0 are one number
    named = rows.select("id", "label", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).withColumn("h", F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws("|", "label", F.array_join(F.transform("v", lambda x: x.cast("string")), ",")), 256)))
    named = materialise(named, "vectors")
    classes = named.filter("v IS NOT NULL").groupBy("h").agg(F.min("id").alias("least"), F.count("*").alias("m"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = materialise(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy(F.size("v").alias("d"), "label").agg(F.count("*").alias("n")).groupBy("d").agg(F.max("n").alias("n"))
    plans = {r["d"]: plan(r["d"], r["n"], cosine) for r in largest.collect()}  # a row a length
    dtype = np.float32 if _element(vectors, vector_col) == "float" else np.float64  # as precise as the input
    hashed = classes.select("rep", "label", "m", "v").mapInArrow(_hash_rows(dtype, plans), "rep long, d int, label string, m long, keys array<long>, v binary")
    hashed = materialise(hashed, "vector-buckets")
    light = hashed.select("rep", "label", "d", F.explode("keys").alias("bucket"))
    place = ["label", "d", "bucket"]
    size = light.groupBy(*place).agg(F.count("*").alias("n")).filter("n > 1").select(*place, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    met = light.join(size, place).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    cols = [*place, "rep"]
    small = met.filter("blocks = 1").select(*cols, F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(2).alias("side"))
    large = met.filter("blocks > 1").select(*cols, "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    sides = small.unionByName(large.select(*cols, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), side.alias("side")))
    sides = materialise(sides, "vector-sides")
    # many small blocks share a group; a group of one large block is bounded by the block's sides
    group = F.pmod(F.xxhash64(*place, "x", "y"), F.lit(max(1, -(-sides.count() // GROUP_ROWS)))).alias("group")
    blocks = sides.select("*", group).join(hashed.select("rep", "m", "keys", "v"), "rep")
    found = materialise(blocks.groupBy("group").applyInArrow(_compare(cosine, dtype), "a long, b long, n long"), "vector-links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    part = components(found.filter("b IS NOT NULL"))
    known = classes.select("h", "rep", "m", "least").join(counts, "rep", "left").join(part, F.col("rep") == part.node, "left")
    known = known.select("h", "least", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    known = materialise(known, "vector-named")
    known = known.join(known.groupBy("c").agg(F.min("least").alias("first")), "c").select("h", "n", "first")
    out = named.select("id", "h").join(known, "h", "left")
    for frame in (hashed, sides, found, classes):
        discard(frame)
    component = F.when(F.col("id").isNotNull(), F.coalesce("first", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _element(vectors: DataFrame, column: str) -> str:
    return vectors.schema[column].dataType.elementType.typeName()


def brute_force(rows: list[tuple], cosine: float) -> list[tuple]:
    """(id, n_links, component_id, kept) of every row by comparing all pairs of one label, for tests."""
    good = {}
    for r, (_, v, label) in enumerate(rows):
        if v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[r] = (label, unit(np.array([v]))[0])
    links = {r: [q for q in good if q != r and good[r][0] == good[q][0] and len(good[r][1]) == len(good[q][1]) and (good[r][1] * good[q][1]).sum() >= cosine] for r in good}
    out = []
    for r, (i, _, _) in enumerate(rows):
        seen, todo = {r}, [r]
        while todo:
            new = [q for q in links.get(todo.pop(), []) if q not in seen]
            seen.update(new)
            todo += new
        least = min(rows[q][0] for q in seen)
        out.append((i, len(links.get(r, [])), least, least == i))
    return sorted(out)
