"""Operator 1: near-duplicate documents by HyperMinHash.

One hash per shingle.  Its low bits choose one of BUCKETS buckets; a bucket's register keeps the
smallest remaining hash as leading-zero count and MANTISSA following bits.  Bands of compressed
registers (empty ones borrow from a fixed order of others) give candidates, the fraction of equal
registers less the expected chance collisions estimates their similarity, and pairs that can
still reach the threshold are verified on the full shingle sets.

Documents with one set are one class, numbered once; classes, not ids, are what is linked.  Within a bucket of a
band classes are first compared with the smallest one (a star, never all pairs).  Then only members
outside a bucket's main component are compared, in blocks, with the rest: first each with its best
estimate in every other component, then with all that the estimate does not rule out.  Blocks verify their
pairs on the spot, on full shingle sets, and give a spanning forest of the links: pairs are never rows.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import hashing as H
from marketlake.llm.common import discard, materialise, tune
from marketlake.llm.components import components

BUCKETS = 256
MANTISSA = 10
EMPTY = 0xFFFF
#: Chance that banding misses a pair exactly at the threshold.
MISS = 1e-4
#: Standard deviations that an estimate may lie below the threshold before a pair is dropped.
SLACK = 4.0
#: Members of one comparison block: those outside the main component, and all.
OUTSIDE, MEMBERS = 1024, 1024
#: Block rows, and shingles of their sets, that one group of blocks should hold.
GROUP_ROWS, GROUP_SHINGLES = 16384, 2_000_000
_BATCH_BYTES = 2 << 20
_ORDER = np.argsort(np.random.Generator(np.random.PCG64(7)).random((BUCKETS, BUCKETS)), axis=1)


def rows_per_band(threshold: float) -> int:
    """The longest band that misses a pair at the threshold with a chance of MISS at most."""
    return max([r for r in range(1, BUCKETS + 1) if (1 - threshold ** r) ** (BUCKETS // r) <= MISS], default=1)


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """The distinct k-word shingles of every whole text as sorted 64-bit hashes.

    A text of fewer words is one shingle, one without words none."""
    buf, s, e, first = H.split([(t or "").encode("utf-8").translate(H.LOWER) for t in texts], H.SPACE_WORDS)
    h = H.word_hashes(buf, s, e)
    w = H.window_hashes(h, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(w[a:b - k + 1]))
        else:
            out.append(H.mix(H.window_hashes(h[a:b], b - a) + np.uint64(b - a)) if b > a else np.empty(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BUCKETS compressed registers per set."""
    low = np.full((len(sets), BUCKETS), np.uint64(1 << 63))
    for row, u in zip(low, sets):
        r = np.sort(((u & np.uint64(BUCKETS - 1)) << np.uint64(56)) | (u >> np.uint64(8)))
        b = (r >> np.uint64(56)).astype(np.int64)
        head = np.flatnonzero(np.append(True, b[1:] != b[:-1])[:len(b)])
        row[b[head]] = r[head] & np.uint64((1 << 56) - 1)
    m, e = np.frexp((low >> np.uint64(3)).astype(np.float64))
    zeros = np.minimum(53 - e, 53).astype(np.int64)
    out = (zeros << MANTISSA) | np.maximum((2 * m - 1) * (1 << MANTISSA), 0).astype(np.int64)
    return np.where(low == np.uint64(1 << 63), EMPTY, out).astype(np.uint16)


def band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    """The band hashes of every row of registers that is not all empty."""
    full = regs.copy()
    missing = regs == EMPTY
    for t in range(BUCKETS):
        at = np.argwhere(missing)
        if not len(at):
            break
        got = regs[at[:, 0], _ORDER[at[:, 1], t]]
        full[at[:, 0], at[:, 1]] = got
        missing[at[:, 0], at[:, 1]] = got == EMPTY
    bands = BUCKETS // rows
    x = full[:, :bands * rows].reshape(len(regs), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), x.shape[:2]).copy()
    for j in range(rows):
        key = H.mix(key * np.uint64(0x9E3779B97F4A7C15) + x[:, :, j])
    return key.view(np.int64)


def collision(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that two unrelated registers are equal, for sets of n and m shingles."""
    n, m = np.maximum(n / BUCKETS, 1.0), np.maximum(m / BUCKETS, 1.0)
    s, p = n + m - 1, np.zeros(np.broadcast(n, m).shape)
    for level in range(54):  # smallest values in [2**-(level+1), 2**-level), in cells of equal width
        a, b = 2.0 ** -(level + 1), 2.0 ** -level
        p += b / 2 / (1 << MANTISSA) * n * m / s * ((1 - a) ** s - (1 - b) ** s)
    return np.clip(p, 0, 0.5)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimated Jaccard similarity, registers it rests on), along the last axis of a and b."""
    ea, eb = a == EMPTY, b == EMPTY
    either = (~(ea & eb)).sum(-1)
    both = (~(ea | eb)).sum(-1)
    equal = ((a == b) & ~ea).sum(-1)
    p = collision(n, m)
    return (equal - p * both) / (1 - p) / np.maximum(either, 1), either


def may_reach(a, b, n, m, threshold: float):
    """(can the pair reach the threshold?, its estimate).

    Registers sample the union without replacement, so where they hold most of a small union the
    estimate is nearly exact: the finite population correction narrows the slack accordingly."""
    j, size = estimate(a, b, n, m)
    size = np.maximum(size, 1)
    seen = np.minimum(size / np.maximum((n + m) / (1 + threshold), 1), 1)
    slack = SLACK * np.sqrt(threshold * (1 - threshold) / size * (1 - seen)) + 1 / size
    sizes_allow = np.minimum(n, m) >= (threshold - 1e-9) * np.maximum(n, m)
    return sizes_allow & (j >= threshold - slack), j


def set_key(u: np.ndarray) -> tuple[int, int]:
    """128 bits that tell shingle sets of one size apart."""
    return tuple(int(np.sum(H.mix(u ^ np.uint64(c)), dtype=np.uint64).astype(np.int64)) for c in (0, 0x5851F42D4C957F2D))


def _in_pieces(texts: list[str | None]):
    """(from, to) of runs of texts of about _BATCH_BYTES."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < _BATCH_BYTES):
            size += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def _signatures(k: int):
    out = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("regs", pa.binary())])

    def run(batches):
        for b in batches:
            ids, hashes, texts = (c.to_pylist() for c in b.columns)
            for i, j in _in_pieces(texts):
                sets = shingle_sets(texts[i:j], k)
                regs = registers(sets)
                k1, k2 = zip(*map(set_key, sets))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    (ids[i:j], hashes[i:j], [len(u) for u in sets], k1, k2, [r.tobytes() for r in regs]), out.types)], schema=out)

    return run


def _bands(rows: int):
    out = pa.schema([("bucket", pa.int64()), ("rep", pa.int64())])

    def run(batches):
        for b in batches:
            if b.num_rows:
                keys = band_keys(_matrix(b.column(1).to_pylist()), rows)
                reps = np.repeat(b.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(reps, pa.int64())], schema=out)

    return run


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint16).reshape(len(blobs), BUCKETS)


def _filter_pairs(threshold: float):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for t in batches:
            if t.num_rows:
                a, b, na, nb = (t.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "na", "nb"))
                ok, _ = may_reach(_matrix(t.column("ra").to_pylist()), _matrix(t.column("rb").to_pylist()), na, nb, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(a[ok], pa.int64()), pa.array(b[ok], pa.int64())], schema=out)

    return run


def _sets(k: int):
    """(rep, sorted shingle hashes) of the texts that were fetched for classes."""
    out = pa.schema([("rep", pa.int64()), ("s", pa.binary())])

    def run(batches):
        for b in batches:
            reps, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in _in_pieces(texts):
                yield pa.RecordBatch.from_arrays([pa.array(reps[i:j], pa.int64()), pa.array([u.tobytes() for u in shingle_sets(texts[i:j], k)], pa.binary())], schema=out)

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Is 100 * intersection >= percent * union, for sorted sets?"""
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(percent: int):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for t in batches:
            ok = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(t.column("sa").to_pylist(), t.column("sb").to_pylist())]
            yield pa.RecordBatch.from_arrays([t.column(c).filter(pa.array(ok, pa.bool_())) for c in ("a", "b")], schema=out)

    return run


class Forest:
    """Union-find over the members of one block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def _candidates(regs, keys, outside, apart, rep, comp, n, bucket: int, threshold: float, best_only: bool):
    """(i, others by falling estimate) for the members of one block that may have links to other components.

    A pair is taken in the first band that both share, and once if both are outside the main component."""
    left, right = np.flatnonzero(outside), np.flatnonzero(~outside)
    if not len(left) or not len(right):
        return
    here = int(np.flatnonzero(keys[left[0]] == bucket)[0])
    for i in left.tolist():
        others = right[(comp[right] != comp[i]) & (~apart[right] | (rep[right] > rep[i]))]
        others = others[~(keys[others, :here] == keys[i, :here]).any(1)] if len(others) else others
        ok, j = may_reach(regs[i], regs[others], n[i], n[others], threshold)
        others, j = others[ok], j[ok]
        if not len(others):
            continue
        order = np.lexsort((rep[others], -j, comp[others]) if best_only else (rep[others], -j))
        others = others[order]
        if best_only:
            c = comp[others]
            others = others[np.append(True, c[1:] != c[:-1])]
        yield i, others


_BLOCK = "bucket long, o int, i int, rep long, comp long, n long, outside boolean, apart boolean"
_BLOCK_COLUMNS = ["bucket", "o", "i", "rep", "comp", "n", "outside", "apart"]


def _blocks(t: pa.Table):
    """(rows of one block, their columns) of a group of blocks."""
    bucket, o, i = (t.column(c).to_numpy() for c in ("bucket", "o", "i"))
    order = np.lexsort((i, o, bucket))
    same = (np.diff(bucket[order]) == 0) & (np.diff(o[order]) == 0) & (np.diff(i[order]) == 0)
    cols = [t.column(c).to_numpy() for c in ("outside", "apart", "rep", "comp", "n")]
    for at in np.split(order, np.flatnonzero(~same) + 1):
        yield at, int(bucket[at[0]]), [c[at] for c in cols]


def _needed(threshold: float, best_only: bool, rows: int):
    """The members of every block that take part in a pair which the estimate can't rule out."""
    def run(t: pa.Table) -> pa.Table:
        regs, keep = _matrix(t.column("regs").to_pylist()), np.zeros(t.num_rows, bool)
        keys = band_keys(regs, rows)
        for at, bucket, cols in _blocks(t):
            for i, others in _candidates(regs[at], keys[at], *cols, bucket, threshold, best_only):
                keep[at[i]] = True
                keep[at[others]] = True
        return t.select(_BLOCK_COLUMNS).filter(pa.array(keep))

    return run


def _link(threshold: float, best_only: bool, rows: int, percent: int):
    """A spanning forest of the verified links of every block."""
    def run(t: pa.Table) -> pa.Table:
        regs, sets = _matrix(t.column("regs").to_pylist()), t.column("s").to_pylist()
        keys = band_keys(regs, rows)
        found: list[list[int]] = [[], []]
        for at, bucket, cols in _blocks(t):
            forest, rep = Forest(len(at)), cols[2]
            known = [np.frombuffer(sets[x], np.uint64) for x in at]
            for i, others in _candidates(regs[at], keys[at], *cols, bucket, threshold, best_only):
                for j in others.tolist():
                    x, y = forest.root(i), forest.root(j)
                    if x != y and similar(known[i], known[j], percent):
                        forest.up[x] = y
                        found[0].append(int(rep[i]))
                        found[1].append(int(rep[j]))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b"])

    return run


def _id_key(c: str):
    """A null id as a value of its own, for equi-joins."""
    return F.coalesce(F.col(c).cast("string"), F.lit("none"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, th (hash of its text), n (shingles), component (a number; null without shingles), and
    first_id, first_th: the id and text hash of its group's first document (smallest id, then hash; a null id comes last)."""
    tune(docs.sparkSession)
    t = percent / 100
    band = rows_per_band(t)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.col(text_col).alias("text"))
    sigs = materialise(source.mapInArrow(_signatures(words), "id long, th long, n long, k1 long, k2 long, regs binary"), "minhash-sigs")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("first")
    classes = sigs.filter("n > 0").groupBy("k1", "k2", "n").agg(first, F.any_value("regs").alias("regs"))
    classes = materialise(classes.withColumn("rep", F.monotonically_increasing_id()), "minhash-classes")
    regs = classes.select("rep", "n", "regs")
    bands = materialise(regs.select("rep", "regs").mapInArrow(_bands(band), "bucket long, rep long"), "minhash-bands")

    def sets_of(reps: DataFrame) -> DataFrame:
        """Shingle sets of classes, from the text of their first document."""
        wanted = classes.join(reps, "rep", "left_semi").select("rep", F.col("first.id").alias("id"), F.col("first.th").alias("th"))
        texts = source.withColumn("key", _id_key("id")).join(wanted.select("rep", "th", _id_key("id").alias("key")), ["key", "th"])
        texts = texts.groupBy("rep").agg(F.any_value("text").alias("text"))  # repeated rows
        return materialise(texts.mapInArrow(_sets(words), "rep long, s binary"), "minhash-sets")

    # stars: every member of a bucket against its smallest
    pivot = bands.groupBy("bucket").agg(F.min("rep").alias("a"), F.count("*").alias("m")).filter("m > 1").drop("m")
    shared = bands.join(pivot, "bucket").filter("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    ra = regs.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    rb = regs.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    pairs = materialise(shared.join(rb, "b").join(ra, "a").mapInArrow(_filter_pairs(t), "a long, b long"), "minhash-pairs")
    sets = sets_of(pairs.select(F.col("a").alias("rep")).distinct().unionByName(pairs.select(F.col("b").alias("rep")).distinct()))
    one = pairs.join(sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
    two = one.join(sets.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b")
    links = [materialise(two.mapInArrow(_verify(percent), "a long, b long"), "minhash-links")]
    for frame in (pairs, sets):
        discard(frame)
    # what a star left apart
    for best_only in (True, False):
        part = components(reduce(DataFrame.unionByName, links))
        named = bands.join(part, bands.rep == part.node, "left").select("bucket", "rep", F.coalesce("component", "rep").alias("comp"))
        per = named.groupBy("bucket", "comp").agg(F.count("*").alias("c"))
        per = per.groupBy("bucket").agg(F.count("*").alias("k"), F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("main")).filter("k > 1")
        per = per.select("bucket", F.col("main.comp").alias("main"), F.ceil((F.col("m") - F.col("main.c")) / OUTSIDE).cast("int").alias("so"), F.ceil(F.col("m") / MEMBERS).cast("int").alias("sm"))
        rows = named.join(per, "bucket")
        spread = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        outer = rows.filter("comp <> main").select("bucket", "rep", "comp", spread(F.col("so")).alias("o"), every(F.col("sm")).alias("i"), F.lit(True).alias("outside"), F.lit(True).alias("apart"))
        inner = rows.select("bucket", "rep", "comp", spread(F.col("sm")).alias("i"), every(F.col("so")).alias("o"), F.lit(False).alias("outside"), (F.col("comp") != F.col("main")).alias("apart"))
        members = materialise(outer.unionByName(inner), "minhash-members")
        # many small blocks share a group; a group of one large block is bounded by the block's sides
        grouped = lambda n: F.pmod(F.xxhash64("bucket", "o", "i"), F.lit(max(1, math.ceil(n)))).alias("group")
        blocks = members.select("*", grouped(members.count() / GROUP_ROWS)).join(regs, "rep")
        needed = materialise(blocks.groupBy("group").applyInArrow(_needed(t, best_only, band), _BLOCK), "minhash-needed")
        sets = sets_of(needed.select("rep").distinct())
        shingles, count = needed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        full = needed.select("*", grouped(max(shingles / GROUP_SHINGLES, count / GROUP_ROWS))).join(regs.drop("n"), "rep").join(sets, "rep")
        links.append(materialise(full.groupBy("group").applyInArrow(_link(t, best_only, band, percent), "a long, b long"), "minhash-links"))
        for frame in (members, needed, sets):
            discard(frame)
    discard(bands)
    part = components(reduce(DataFrame.unionByName, links))
    named = classes.join(part, classes.rep == part.node, "left").select("k1", "k2", "n", "first", F.coalesce("component", "rep").alias("component"))
    firsts = named.groupBy("component").agg(F.min("first").alias("f"))
    named = materialise(named.drop("first").join(firsts, "component").select("k1", "k2", "n", "component", F.col("f.id").alias("first_id"), F.col("f.th").alias("first_th")), "minhash-named")
    for frame in (classes, *links):
        discard(frame)
    return sigs.select("id", "th", "n", "k1", "k2").join(named, ["k1", "k2", "n"], "left").select("id", "th", "n", "component", "first_id", "first_th")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: n_shingles, component_id (smallest linked id), kept (it is that one).

    Documents whose sets of ``words``-word shingles (A-Z lower-cased, words [^\\x20\\x09-\\x0D]+) have
    100 * intersection >= ``percent`` * union are linked.  Null and empty texts, and those without
    words, link with nothing and are kept.  Texts are linked, not ids: rows of one id with different texts each belong to
    their own text's group, whatever the order of rows.  A row with a null id belongs to its text's group as well; it
    is kept only where no row of the group has an id and its text is the first of those (component_id is then null).
    Ties go to the smaller id, then to the smaller hash of the text; repeated rows share their result; an empty table gives no rows."""
    rows = groups(docs, id_col, text_col, words, percent)
    grouped = F.col("component").isNotNull()
    component = F.when(grouped, F.col("first_id")).otherwise(F.col("id"))
    kept = ~grouped | (F.col("id").eqNullSafe(F.col("first_id")) & (F.col("id").isNotNull() | (F.col("th") == F.col("first_th"))))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest id, then of the smallest hash of the text.

    A null id comes last, and copies with null ids join their text's group; of repeated rows of one id and text one stays
    (the smallest by its columns as JSON).  Rows without shingles all stay."""
    rows = materialise(groups(docs, id_col, text_col, **options).filter("component IS NOT NULL"), "minhash-groups")
    first = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("th") == F.col("first_th"))
    key = [_id_key("id").alias("_key"), F.col("th").alias("_th")]
    gone = rows.filter(~first).select(*key).distinct()
    twice = materialise(rows.filter(first).groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "minhash-repeated")
    keyed = docs.withColumns({"_key": F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("none")), "_th": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    left = keyed.join(gone, ["_key", "_th"], "left_anti")
    if twice.isEmpty():
        return left.select(*docs.columns)
    again = left.join(twice, ["_key", "_th"], "left_semi").groupBy("_key", "_th").agg(F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*docs.columns))).alias("_row"))
    return left.join(twice, ["_key", "_th"], "left_anti").select(*docs.columns).unionByName(again.select("_row.*"))


def brute_force(docs: list[tuple], words: int, percent: int) -> list[tuple]:
    """(id, n_shingles, component_id, kept) of every row by comparing all pairs, for tests; ids are not null."""
    sets = []
    for _, t in docs:
        w = (t or "").encode("utf-8").translate(H.LOWER).split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    forest = Forest(len(docs))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                forest.up[forest.root(i)] = forest.root(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(docs):
        least[forest.root(i)] = min(d, least.get(forest.root(i), d))
    return sorted((d, len(sets[i]), least[forest.root(i)], least[forest.root(i)] == d) for i, (d, _) in enumerate(docs))
