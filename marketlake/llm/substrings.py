"""Operator 4: substring dedup with fixed-block anchors.

Index: the non-overlapping blocks of BLOCK words of every document.  Probe: every rolling
window of BLOCK words of every document.  A passage of ``window`` >= 2 * BLOCK words that occurs
twice holds a whole indexed block of either copy, so it lies around a hit.  Hits are extended:
every full window around one is compared with all others by a 96-bit hash and removed unless it
is the first of its kind; runs of such windows are the maximal exact repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import hashing as H
from marketlake.llm import shards as S
from marketlake.llm.common import discard, materialise

#: Words of a repeat, and of an indexed block.
WINDOW = 20


def _words(shard: S.Shard):
    buf, s, e, first = H.split(shard.texts(), H.SPACE_WORDS)
    return H.word_hashes(buf, s, e), first


def _probes(parts: int, block: int):
    """Distinct block windows of a shard, with a mark for those indexed and for those it has twice."""
    def fn(shard: S.Shard, _):
        h, first = _words(shard)
        w = H.window_hashes(h, block)
        at = np.flatnonzero(H.whole_windows(first, len(h), block))
        if not len(at):
            return
        start = np.repeat(first[:-1], np.diff(first))
        aligned = (at - start[at]) % block == 0
        w = w[at]
        order = np.argsort(w, kind="stable")
        sw = w[order]
        head = np.flatnonzero(np.append(True, sw[1:] != sw[:-1]))
        n = np.diff(np.append(head, len(sw)))
        flag = np.maximum.reduceat(aligned[order].astype(np.uint32), head) | ((n > 1).astype(np.uint32) << 1)
        key, idx = sw[head], at[order[head]].astype(np.uint32)
        part, low = _part(key, parts)
        # sorted by hash within a part, so that differences are small
        by = np.argsort(part, kind="stable")
        yield from S.by_part(shard.shard, part, by, [low, idx, flag.astype(np.uint8)], "P")

    return fn


def _part(key: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of a hash and 32 further bits of it."""
    return ((key >> np.uint64(32)) % np.uint64(parts)).astype(np.int32), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _hits(rows: list[tuple]):
    """Which probes meet an indexed block other than themselves; both sides are told."""
    got = [S.expand(b, [np.uint32, np.uint32, np.uint8]) for _, _, b in rows]
    low, idx, flag = (np.concatenate(c) for c in zip(*got))
    owner = np.repeat(np.arange(len(rows)), [len(g[0]) for g in got])
    order = np.argsort(low, kind="stable")
    s = low[order]
    head = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    n = np.diff(np.append(head, len(s)))
    bits = np.bitwise_or.reduceat(flag[order], head)
    hit = ((bits & 1) > 0) & ((n > 1) | ((bits & 2) > 0))
    chosen = order[np.repeat(hit, n)]
    yield from _answer(rows, owner[chosen], idx[chosen], "H")


def _answer(rows: list[tuple], owner: np.ndarray, idx: np.ndarray, kind: str):
    order = np.argsort(owner, kind="stable")
    owner, idx = owner[order], idx[order]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(owner)]):
        if b > a:
            yield rows[owner[a]][0], kind, S.squeeze([np.sort(idx[a:b])])


def _candidates(parts: int, block: int, window: int):
    """Full windows around hits: the first of each kind in the shard asks its part, later ones go at once."""
    def fn(shard: S.Shard, answers: list[bytes]):
        (hit,) = S.read_answers(answers, "H", [np.uint32])
        if not len(hit):
            return
        h, first = _words(shard)
        w = H.window_hashes(h, block)
        ok = H.whole_windows(first, len(h), block)
        known = np.sort(w[hit])
        slot = np.minimum(np.searchsorted(known, w), len(known) - 1)
        marked = np.concatenate([[0], np.cumsum((known[slot] == w) & ok)])
        full = np.flatnonzero(H.whole_windows(first, len(h), window))
        # an indexed block starts at one of the first window - block + 1 words of the window
        at = full[marked[full + window - block + 1] > marked[full]]
        if not len(at):
            return
        h1, h2 = H.window_hashes(h, window)[at], H.window_hashes(H.mix(h + np.uint64(0x632BE59BD9B4E019)), window)[at]
        h2 = (h2 >> np.uint64(32)).astype(np.uint32)
        doc = np.searchsorted(first, at, "right") - 1
        ids, start = shard.ids[doc], at - first[doc]
        order = np.lexsort((start, ids, h2, h1))
        a, b = h1[order], h2[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        head = np.flatnonzero(new)
        lead = order[np.repeat(head, np.diff(np.append(head, len(order))))]
        # repeated rows of one document share its id and place: none of them is earlier
        later = (ids[order] != ids[lead]) | (start[order] != start[lead])
        gone = at[order[later]]
        pick = order[head]
        part, low = _part(h1[pick], parts)
        by = np.argsort(part, kind="stable")
        yield from S.by_part(shard.shard, part, by, [h1[pick], h2[pick], at[pick].astype(np.uint32), ids[pick], start[pick].astype(np.uint32)], "W")
        same = order[~later & ~new]  # repeated rows: they share their leader's fate, so they ask as well
        if len(same):
            part, _ = _part(h1[same], parts)
            yield from S.by_part(shard.shard, part, np.argsort(part, kind="stable"),
                                 [h1[same], h2[same], at[same].astype(np.uint32), ids[same], start[same].astype(np.uint32)], "W")
        if len(gone):
            yield int(gone[0] % parts), shard.shard, "L", S.squeeze([np.sort(gone).astype(np.uint32)])

    return fn


def _later(rows: list[tuple]):
    """Windows with an earlier equal window in another shard."""
    for shard, kind, blob in rows:
        if kind == "L":
            yield shard, "R", blob
    rows = [r for r in rows if r[1] == "W"]
    if not rows:
        return
    types = [np.uint64, np.uint32, np.uint32, np.int64, np.uint32]
    got = [S.expand(b, types) for _, _, b in rows]
    h1, h2, idx, ids, start = (np.concatenate(c) for c in zip(*got))
    owner = np.repeat(np.arange(len(rows)), [len(g[0]) for g in got])
    order = np.lexsort((start, ids, h2, h1))
    a, b = h1[order], h2[order]
    head = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    lead = order[np.repeat(head, np.diff(np.append(head, len(order))))]
    chosen = order[(ids[order] != ids[lead]) | (start[order] != start[lead])]
    yield from _answer(rows, owner[chosen], idx[chosen], "R")


_OUT = "id long, tag long, n_words long, n_removed long, kept_sha256 string, kept string, spans array<struct<start:long,n_words:long>>"


def _finish(window: int, texts: bool, spans: bool):
    def fn(shard: S.Shard, answers: list[bytes]):
        (gone,) = S.read_answers(answers, "R", [np.uint32])
        docs = [t.split(b" ") if t else [] for t in shard.texts()]
        first = np.cumsum([0, *map(len, docs)])
        mask = S.cover(gone.astype(np.int64), window, int(first[-1]))
        for i, words in enumerate(docs):
            m = mask[first[i]:first[i + 1]]
            n = int(m.sum())
            a, b = S.runs(m) if n else ((), ())
            if n:
                out, p = [], 0
                for x, y in zip(a.tolist(), b.tolist()):
                    out += words[p:x]
                    p = y
                words, total = out + words[p:], len(words)
            else:
                total = len(words)
            kept = b" ".join(words)
            yield (shard.id(i), int(shard.tags[i]), total, n, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8") if texts else None,
                   [{"start": int(x), "n_words": int(y - x)} for x, y in zip(a, b)] if spans else None)

    return fn


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, texts: bool = True,
          spans: bool = True, shard_bytes: int = S.SHARD_BYTES, tag_col: str | None = None) -> DataFrame:
    """One row per document: n_words, n_removed, kept_sha256, kept text, spans of removed words.

    Words are [^\\x20\\x09-\\x0D]+, unchanged.  A word goes if a window of ``window`` words that covers it
    also starts earlier (smaller id, or earlier in the same document); windows are judged on the input.
    Null and empty texts have no words; a null id orders last; repeated rows of one id count as one
    document and each keep their result; an empty table gives no rows.  ``window`` must be 2 or more.
    A long column ``tag_col`` passes through."""
    if window < 2:
        raise ValueError("window must be 2 or more")
    block = window // 2
    shards = S.build(docs, id_col, text_col, lambda d: b" ".join(d.split()), lambda d: d.count(b" ") + bool(d), "substring-shards", shard_bytes, tag_col)
    parts = S.n_parts(shards)
    probes = S.each_shard(shards, _probes(parts, block), S.ENTRY, S.ENTRY_ARROW)
    hits = materialise(S.each_part(probes, _hits), "substring-hits")
    asked = S.each_shard(S.with_answers(shards, hits), _candidates(parts, block, window), S.ENTRY, S.ENTRY_ARROW, answers=True)
    gone = materialise(S.each_part(asked, _later), "substring-repeats")
    discard(hits)
    arrow = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()),
                       ("spans", pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64())])))])
    out = S.each_shard(S.with_answers(shards, gone), _finish(window, texts, spans), _OUT, arrow, answers=True)
    drop = [c for c, wanted in (("kept", texts), ("spans", spans), ("tag", tag_col)) if not wanted]
    return out.drop(*drop).withColumnsRenamed({"id": id_col, **({"tag": tag_col} if tag_col else {})})


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **options) -> DataFrame:
    """``docs`` with the words of repeats gone from their texts; documents left without a word go.

    Texts that lose nothing stay as they are; the words of others are joined by one space."""
    tagged = docs.withColumn("_tag", F.xxhash64(F.col(id_col), F.col(text_col)))
    found = dedup(tagged, id_col, text_col, window, spans=False, tag_col="_tag", **options).filter("n_removed > 0")
    found = found.select(F.col("_tag").alias("_t"), F.col(id_col).alias("_i"), F.col("kept").alias("_kept"), (F.col("n_removed") == F.col("n_words")).alias("_all"))
    found = found.dropDuplicates(["_t", "_i"])  # repeated rows have one result
    both = tagged.join(found, (F.col("_tag") == F.col("_t")) & F.col(id_col).eqNullSafe(F.col("_i")), "left")
    both = both.filter(~F.coalesce("_all", F.lit(False))).withColumn(text_col, F.coalesce("_kept", text_col))
    return both.select(*docs.columns)


def brute_force(docs: list[tuple], window: int = WINDOW) -> list[tuple]:
    """(id, n_words, n_removed, kept_sha256) by plain comparison, for tests."""
    seen, rows = set(), []
    for d, t in sorted(docs):
        w = (t or "").encode("utf-8").split()
        gone = set()
        for a in range(len(w) - window + 1):
            key = tuple(w[a:a + window])
            if key in seen:
                gone.update(range(a, a + window))
            seen.add(key)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        rows.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return rows
