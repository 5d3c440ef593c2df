"""Operator 5: benchmark decontamination with training suffix arrays.

The training words are held in shards, each with a suffix array over word ids.  Every
suffix of every test item is binary-searched in every shard, one word deeper at a time:
the interval left when the next word no longer occurs is the longest verbatim match, and
the interval at the window length holds all places where that window occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm import hashing as H
from marketlake.llm.common import arrow_schema, materialise

#: Window length in words.
WINDOW = 10
#: Training text of a shard in bytes, and words of a suffix array; longer documents span several arrays.
SHARD_BYTES = 3 << 20
SHARD_WORDS = 1 << 20
#: Text of one broadcast block of test items in bytes; more items make more blocks.
BLOCK_BYTES = 16 << 20


class Tests:
    """One block of test items as word hashes, item after item."""

    def __init__(self, items: list[tuple[int, str | None]], window: int):
        self.window = window
        self.ids = [str(i) for i, _ in items]
        buf, s, e, first = H.split([(t or "").encode("utf-8").translate(H.LOWER) for _, t in items], H.ALNUM_WORDS)
        self.hashes = H.word_hashes(buf, s, e)
        lens = np.diff(first)
        self.item = np.repeat(np.arange(len(items)), lens)
        self.left = np.repeat(first[1:], lens) - np.arange(len(s))  # words from a suffix's start to its item's end
        whole = np.repeat(lens, lens)
        # the window that starts at a suffix, in words: 0 where none does
        self.need = np.where(self.left >= window, window, np.where((whole < window) & (self.left == whole), whole, 0))
        self.depth = int(lens.max(initial=0))


def suffix_array(seq: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Positions of seq[:n] with seq > 0 in the order of their suffixes' first ``depth`` words.

    ``seq`` is padded with zeros beyond n.  Prefix doubling; only unresolved groups are sorted again."""
    sa = np.flatnonzero(seq[:n] > 0)
    k = 3 if seq.max(initial=0) < 1 << 21 else 1
    key = seq[sa] if k == 1 else (seq[sa] << 42) | (seq[sa + 1] << 21) | seq[sa + 2]
    order = np.argsort(key)
    sa, key = sa[order], key[order]
    rank = np.zeros(len(seq), np.int64)
    slots = np.arange(len(sa))
    while len(slots):
        head = np.ones(len(slots), bool)
        head[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(head)
        rank[sa[slots]] = np.repeat(slots[starts], np.diff(np.append(starts, len(slots)))) + 1
        single = head & np.append(head[1:], True)
        slots = slots[~single]
        if k >= depth or not len(slots):
            break
        at = sa[slots]
        # the upper half keeps every group within its own slots
        key = (rank[at] << 32) | rank[np.minimum(at + k, len(rank) - 1)]
        order = np.argsort(key, kind="stable")
        sa[slots], key = at[order], key[order]
        k *= 2
    return sa


class Shard:
    """Suffix array of a stretch of training words."""

    def __init__(self, words: np.ndarray, first: np.ndarray, depth: int):
        n_docs = len(first) - 1
        self.vocab, ids = np.unique(words, return_inverse=True)
        self.n = len(words) + n_docs
        self.seq = np.zeros(self.n + max(4, depth) + 1, np.int64)
        doc = np.repeat(np.arange(n_docs), np.diff(first))
        at = np.arange(len(words)) + doc  # a zero after each document ends its suffixes
        self.seq[at] = ids + 1
        self.doc_at = np.zeros(self.n, np.int64)
        self.doc_at[at] = doc
        self.sa = suffix_array(self.seq, self.n, depth)

    def word(self, slots: np.ndarray) -> np.ndarray:
        """Word numbers of suffix array slots."""
        return self.sa[slots] - self.doc_at[self.sa[slots]]

    def search(self, tests: Tests):
        """(longest match of each test suffix, its interval, the interval at the suffix's window)."""
        m = len(tests.hashes)
        at = np.searchsorted(self.vocab, tests.hashes)
        at[at == len(self.vocab)] = 0
        pat = np.where(self.vocab[at] == tests.hashes, at + 1, -1) if len(self.vocab) else np.full(m, -1)
        lo, hi = np.zeros(m, np.int64), np.full(m, len(self.sa))
        longest, win_lo, win_hi = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
        live = np.arange(m)
        firsts = self.seq[self.sa]
        d = 0
        while len(live):
            live = live[tests.left[live] > d]
            want = pat[live + d]
            live, want = live[want > 0], want[want > 0]
            if d == 0:
                a, b = np.searchsorted(firsts, want), np.searchsorted(firsts, want, "right")
            else:
                a, b = self._bound(lo[live], hi[live], want, d), self._bound(lo[live], hi[live], want + 1, d)
            found = b > a
            live = live[found]
            lo[live], hi[live] = a[found], b[found]
            d += 1
            longest[live] = d
            here = live[tests.need[live] == d]
            win_lo[here], win_hi[here] = lo[here], hi[here]
        return longest, lo, win_lo, win_hi

    def _bound(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray, d: int) -> np.ndarray:
        """First slot of [lo, hi) whose suffix has a word >= value at depth d."""
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            less = self.seq[self.sa[mid] + d] < value[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]


def _probe(texts: list[bytes], tests: Tests):
    """Per document: (n_words, hit mask's sum, item indexes, longest match, its item, its start word)."""
    buf, s, e, first = H.split(texts, H.ALNUM_WORDS)
    words = H.word_hashes(buf, s, e)
    del buf, s, e
    n, n_docs = len(words), len(texts)
    doc_of = np.repeat(np.arange(n_docs), np.diff(first))
    delta = np.zeros(n + 1, np.int32)
    pairs: set[tuple[int, int]] = set()
    best = [(0, -1, -1)] * n_docs
    over = max(tests.depth, 1) - 1
    for a in range(0, n, SHARD_WORDS):
        b = min(n, a + SHARD_WORDS + over)
        f = np.clip(first, a, b) - a
        shard = Shard(words[a:b], f, max(tests.depth, 1))
        longest, lo, wl, wh = shard.search(tests)
        top = np.flatnonzero(longest)
        at = shard.word(lo[top]) + a
        order = np.argsort(longest[top], kind="stable")
        for i in order[np.searchsorted(longest[top][order], min(tests.window, over + 1)):]:
            d, t = doc_of[at[i]], top[i]
            best[d] = max(best[d], (int(longest[t]), int(tests.item[t]), int(at[i] - first[d])))
        hits = np.flatnonzero(wh > wl)
        # equal windows have the same interval: enumerate its places once
        runs, which = np.unique(wl[hits], return_inverse=True)
        by_run: dict[int, list[int]] = {}
        for r, t in zip(which, hits):
            by_run.setdefault(r, []).append(t)
        for r, ts in by_run.items():
            p = shard.word(np.arange(wl[ts[0]], wh[ts[0]])) + a
            size = int(tests.need[ts[0]])
            np.add.at(delta, p, 1)
            np.add.at(delta, p + size, -1)
            items = {int(tests.item[t]) for t in ts}
            pairs.update((int(d), i) for d in np.unique(doc_of[p]) for i in items)
    mask = np.cumsum(delta[:n]) > 0
    n_hit = np.add.reduceat(np.append(mask, False).astype(np.int64), np.minimum(first[:-1], n)) if n_docs else []
    items = [[] for _ in range(n_docs)]
    for d, i in pairs:
        items[d].append(i)
    counts = np.diff(first)
    spans = []
    for d in range(n_docs):
        if items[d]:
            m = mask[first[d]:first[d + 1]]
            edge = np.flatnonzero(np.diff(np.concatenate([[False], m, [False]])))
            spans.append([{"start": int(x), "n_words": int(y - x)} for x, y in zip(edge[::2], edge[1::2])])
        else:
            spans.append([])
    return counts, np.where(counts > 0, n_hit, 0), items, best, spans


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The test items in blocks of at most ``block_bytes`` of text (or one longer item)."""
    rows = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    size = F.octet_length(F.coalesce("t", F.lit("")))
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    n = 1
    if total[0] > block_bytes:
        n = -(-2 * total[0] // block_bytes)
        part = F.pmod(F.xxhash64("i", "t"), F.lit(n))
        while n > 1 and rows.groupBy(part).agg(F.sum(size).alias("b")).agg(F.max("b")).first()[0] > max(block_bytes, total[1]) and n < 1 << 20:
            n *= 2
            part = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    if n == 1:
        yield [tuple(r) for r in rows.collect()]  # at most block_bytes, measured above
        return
    # laid out by block once, so that a block's read skips the others
    laid = materialise(rows.withColumn("k", part).repartition("k").sortWithinPartitions("k"), "decontam-items")
    for k in range(n):
        yield [tuple(r) for r in laid.filter(F.col("k") == k).select("i", "t").collect()]


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
            keep: list[str] | None = None) -> DataFrame:
    """One row per document: n_words, n_hit, items (ids as strings, sorted), spans of hit words,
    and the longest verbatim match of at least a window (words, item, start word).

    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the whole lower-cased (A-Z) text; a null or
    empty text has none and is clean.  An item of fewer words than ``window`` is one window; one
    without words matches nothing.  Repeated rows repeat their result; an empty benchmark or
    document table gives clean rows or none.  Columns of ``keep`` pass through."""
    keep = [id_col] if keep is None else keep
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("n_words", T.LongType())]))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
              T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", span),
              T.StructField("longest", T.LongType()), T.StructField("longest_item", T.StringType()),
              T.StructField("longest_start", T.LongType())]
    new = {f.name for f in fields}
    keep = [c for c in keep if c not in new]
    out = T.StructType([*[docs.schema[c] for c in keep], *fields])
    sent = list(dict.fromkeys([*keep, text_col]))
    n_keep, at = len(keep), sent.index(text_col)
    schema = arrow_schema(T.StructType(fields))
    spark = docs.sparkSession

    def one(box, frame: DataFrame) -> DataFrame:

        def run(batches):
            tests = Tests(box.value, window)

            def flush(held, texts):
                counts, n_hit, items, best, spans = _probe(texts, tests)
                k = 0
                for b in held:
                    r = range(k, k + b.num_rows)
                    k += b.num_rows
                    cols = [[int(counts[i]) for i in r], [int(n_hit[i]) for i in r],
                            [sorted({tests.ids[j] for j in items[i]}) for i in r], [spans[i] for i in r],
                            [best[i][0] for i in r], [tests.ids[best[i][1]] if best[i][1] >= 0 else None for i in r],
                            [best[i][2] if best[i][0] else None for i in r]]
                    yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(n_keep)],
                                                      *[pa.array(c, f.type) for c, f in zip(cols, schema)]],
                                                     [f.name for f in out])

            held, texts, size = [], [], 0
            for b in batches:
                start = 0
                col = b.column(at).to_pylist()
                for i, t in enumerate(col):
                    data = (t or "").encode("utf-8").translate(H.LOWER)
                    texts.append(data)
                    size += len(data)
                    if size >= SHARD_BYTES:
                        held.append(b.slice(start, i + 1 - start))
                        yield from flush(held, texts)
                        held, texts, size, start = [], [], 0, i + 1
                if start < b.num_rows:
                    held.append(b.slice(start))
            if texts:
                yield from flush(held, texts)

        return frame.select(*sent).mapInArrow(run, out)

    box = spark.sparkContext.broadcast  # of one block: at most BLOCK_BYTES of text
    todo = blocks(benchmark, item_col, item_text_col)
    first, second = next(todo), next(todo, None)
    if second is None:
        return one(box(first), docs)
    # several blocks, one after the other: a document's results from all of them are merged, so each row needs a key
    keyed = materialise(docs.select(*sent).withColumn("_row", F.monotonically_increasing_id()), "decontam-rows")
    keep.append("_row")
    out = T.StructType([*[keyed.schema[c] for c in keep], *fields])
    sent.append("_row")
    sent = [*keep, *[c for c in sent if c not in keep]]
    n_keep, at = len(keep), sent.index(text_col)
    written = []
    for b in chain([first, second], todo):
        held = box(b)
        part = one(held, keyed)
        # the first block's rows tell all documents' words, the others' only hits
        written.append(materialise(part.filter("n_hit > 0") if written else part, "decontam-hits"))
        held.destroy()
    return _merged(written, [c for c in keep if c != "_row"])


def _merged(parts: list[DataFrame], keep: list[str]) -> DataFrame:
    """The results of several blocks as one row per document; ``parts[0]`` holds all documents."""
    hits = reduce(DataFrame.unionByName, [p.filter("n_hit > 0").select("_row", "items", "spans", "longest", "longest_item", "longest_start") for p in parts])
    found = hits.groupBy("_row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                                     F.max(F.struct("longest", "longest_item", "longest_start")).alias("_top"))
    # spans are joined as intervals: a run begins where no earlier one reaches
    w = Window.partitionBy("_row").orderBy("a", "b")
    ends = hits.select("_row", F.explode("spans").alias("s")).select("_row", F.col("s.start").alias("a"), (F.col("s.start") + F.col("s.n_words")).alias("b"))
    reach = ends.withColumn("far", F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    runs = reach.withColumn("run", F.sum(F.when(F.col("a") <= F.col("far"), 0).otherwise(1)).over(w))
    runs = runs.groupBy("_row", "run").agg(F.min("a").alias("start"), (F.max("b") - F.min("a")).alias("n_words"))
    spans = runs.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "n_words"))).alias("spans"), F.sum("n_words").alias("n_hit"))
    base = parts[0].select(*keep, "_row", "n_words")
    return (base.join(found.join(spans, "_row"), "_row", "left")
            .select(*keep, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce("spans", F.array().cast(parts[0].schema["spans"].dataType)).alias("spans"),
                    F.coalesce("_top.longest", F.lit(0).cast("long")).alias("longest"), "_top.longest_item", "_top.longest_start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents in which a window of any item occurs verbatim."""
    inner = docs.withColumns({f"_kept_{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)})
    own = [f"_kept_{i}" for i in range(len(docs.columns))]
    hit = matches(inner, benchmark, keep=own, **options).filter("n_hit = 0")
    return hit.select(*[F.col(o).alias(c) for o, c in zip(own, docs.columns)])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest of ``matches``: counts and a hash of the item ids that occur."""
    return found.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The digest by plain comparison, for tests."""
    def words(t):
        out, cur = [], bytearray()
        for b in (t or "").encode("utf-8").translate(H.LOWER) + b"\x00":
            if H.ALNUM_WORDS[b]:
                cur.append(b)
            elif cur:
                out.append(bytes(cur))
                cur = bytearray()
        return out

    rows = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for i, t in items:
            p = words(t)
            k = min(window, len(p))
            for a in range(len(p) - k + 1 if k else 0):
                for b in range(len(w) - k + 1):
                    if w[b:b + k] == p[a:a + k]:
                        hit.update(range(b, b + k))
                        found.add(str(i))
        ids = sorted(found)
        rows.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return rows
