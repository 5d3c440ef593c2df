"""Operator 6: repeated byte strings by suffix arrays and longest-previous-factor arrays.

Any two equal strings of ``length`` bytes have the same minimiser: the smallest of the hashes of
their GRAM-byte grams, the leftmost among equals.  Windows are therefore handled by minimiser:

1. minimisers that occur once in the corpus, and the windows around them, are out;
2. the stretches of text around a repeated minimiser meet in one part, where a suffix array over
   them orders all windows, and the previous and next smaller positions in suffix order give
   each window its longest previous factor: an earlier equal window, if there is one;
3. a minimiser with very many stretches is split: its windows are dealt out by a 96-bit hash of
   their bytes, one per shard and hash, and compared by that.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from marketlake.llm import hashing as H
from marketlake.llm import shards as S
from marketlake.llm.common import discard, materialise

#: Bytes of a repeat and of the grams whose smallest hash names a window.
LENGTH = 400
GRAM = 32
#: Stretches of one minimiser that are still compared in one suffix array.
HOT = 2000
#: Text bytes of one suffix array (one minimiser's stretches may exceed it, up to HOT of them).
ARRAY_BYTES = 1 << 20
_BLOCK = 1 << 19
_POS = np.uint64((1 << 20) - 1)


def _sliding_min(key: np.ndarray, w: int) -> np.ndarray:
    n, m, size = len(key) - w + 1, key, 1
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:n], m[w - size:w - size + n])


def stretches(data: np.ndarray, first: np.ndarray, length: int):
    """Runs of window starts that share a minimiser: (first start, last start, gram hash)."""
    n, gram = len(data), max(1, min(GRAM, length // 2))
    w = length - gram + 1
    ok = H.whole_windows(first, n, length)
    out = [[], [], []]
    for a in range(0, n - length + 1, _BLOCK):
        b = min(n - length + 1, a + _BLOCK)
        if not ok[a:b].any():
            continue
        g = H.window_hashes(H._BYTE[data[a:b + length - 1]], gram)
        key = (g & ~_POS) | np.arange(len(g), dtype=np.uint64)
        m = _sliding_min(key, w)
        m[~ok[a:b]] = ~np.uint64(0)
        head = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
        last = np.append(head[1:], len(m)) - 1
        keep = ok[a:b][head]
        out[0].append(head[keep] + a)
        out[1].append(last[keep] + a)
        out[2].append(m[head[keep]] & ~_POS)
    return [np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, (np.int64, np.int64, np.uint64))]


def _load(shard: S.Shard, length: int):
    data = np.frombuffer(shard.data, np.uint8)
    first = np.append(shard.begin, len(data))
    return data, first, stretches(data, first, length)


def _part(key: np.ndarray, parts: int):
    return ((key >> np.uint64(20)) % np.uint64(parts)).astype(np.int32)


def _grams(parts: int, length: int):
    """Distinct minimisers of a shard with their number of stretches."""
    def fn(shard: S.Shard, _):
        _, _, (_, _, g) = _load(shard, length)
        if not len(g):
            return
        g, idx, n = np.unique(g, return_index=True, return_counts=True)
        part = _part(g, parts)
        yield from S.by_part(shard.shard, part, np.argsort(part, kind="stable"),
                             [g, idx.astype(np.uint32), np.minimum(n, 65535).astype(np.uint16)], "P")

    return fn


def _repeated(rows: list[tuple]):
    """Minimisers with two stretches or more: H, or G if they are many."""
    got = [S.expand(b, [np.uint64, np.uint32, np.uint16]) for _, _, b in rows]
    g, idx, n = (np.concatenate(c) for c in zip(*got))
    owner = np.repeat(np.arange(len(rows)), [len(x[0]) for x in got])
    order = np.argsort(g, kind="stable")
    s = g[order]
    head = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    total = np.add.reduceat(n[order].astype(np.int64), head)
    total = np.repeat(total, np.diff(np.append(head, len(s))))
    for kind, mine in (("H", (total > 1) & (total <= HOT)), ("G", total > HOT)):
        at = order[mine]
        by = np.argsort(owner[at], kind="stable")
        o, i = owner[at][by], idx[at][by]
        cuts = np.flatnonzero(np.diff(o)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(o)]):
            if b > a:
                yield rows[o[a]][0], kind, S.squeeze([i[a:b]])


_C_TYPES = [np.uint64, np.int64, np.uint32, np.uint32, np.uint32, np.uint8]


def _gather(parts: int, length: int, keep_first: bool):
    """A shard's stretches around repeated minimisers, each different one once; and what it knows by itself."""
    def fn(shard: S.Shard, answers: list[bytes]):
        if not answers:
            return
        data, first, (s0, s1, g) = _load(shard, length)
        local = []
        doc = np.searchsorted(first, s0, "right") - 1
        for kind in "HG":
            (idx,) = S.read_answers(answers, kind, [np.uint32])
            if not len(idx):
                continue
            runs = np.flatnonzero(np.isin(g, g[idx]))
            if kind == "H":
                yield from _contexts(shard, runs, s0, s1, g, doc, first, parts, length, keep_first, local)
            else:
                yield from _windows(shard, data, runs, s0, s1, first, parts, length, keep_first, local)
        if local:
            starts, n = (np.concatenate(c).astype(np.uint32) for c in zip(*local))
            yield int(shard.shard % parts), shard.shard, "L", S.squeeze([starts, n])

    return fn


def _contexts(shard, runs, s0, s1, g, doc, first, parts, length, keep_first, local):
    seen: dict[bytes, list[int]] = {}
    raw = shard.data
    for r in runs.tolist():
        seen.setdefault(raw[s0[r]:s1[r] + length], []).append(r)
    lead = np.array([v[0] for v in seen.values()])  # runs ascend by document id and place
    multi = np.array([len(v) > 1 for v in seen.values()])
    again = [r for v in seen.values() if len(v) > 1 for r in (_strictly_later(v, shard, s0, doc, first) if keep_first else v)]
    if again:
        again = np.array(again)
        local.append((s0[again], s1[again] - s0[again] + 1))
    part = _part(g[lead], parts)
    texts = list(seen)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)]):
        at = order[a:b]
        r = lead[at]
        head = S.squeeze([g[r], shard.ids[doc[r]], (s0[r] - first[doc[r]]).astype(np.uint32), s0[r].astype(np.uint32),
                          (s1[r] - s0[r] + 1).astype(np.uint32), multi[at].astype(np.uint8)])
        body = zstandard.ZstdCompressor(level=1).compress(b"".join(texts[i] for i in at))
        yield int(part[at[0]]), shard.shard, "C", len(head).to_bytes(4, "little") + head + body


def _strictly_later(runs, shard, s0, doc, first):
    place = lambda r: (int(shard.ids[doc[r]]), int(s0[r] - first[doc[r]]))
    low = min(map(place, runs))
    return [r for r in runs if place(r) > low]


def _windows(shard, data, runs, s0, s1, first, parts, length, keep_first, local):
    for i in range(0, len(runs), 4096):  # bounded scratch arrays
        chunk = runs[i:i + 4096]
        at, h1, h2 = [], [], []
        for a, b in _joined(s0[chunk], s1[chunk]):
            x = H._BYTE[data[a:b + length]]
            at.append(np.arange(a, b + 1))
            h1.append(H.window_hashes(x, length))
            h2.append(H.window_hashes(H.mix(x), length) >> np.uint64(32))
        at, h1, h2 = np.concatenate(at), np.concatenate(h1), np.concatenate(h2).astype(np.uint32)
        doc = np.searchsorted(first, at, "right") - 1
        ids, start = shard.ids[doc], at - first[doc]
        order = np.lexsort((start, ids, h2, h1))
        x, y = h1[order], h2[order]
        head = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
        n = np.diff(np.append(head, len(order)))
        lead = order[np.repeat(head, n)]
        if keep_first:
            again = order[(ids[order] != ids[lead]) | (start[order] != start[lead])]
            pick = order[~((ids[order] != ids[lead]) | (start[order] != start[lead]))]
            multi = np.zeros(len(pick), np.uint8)
        else:
            again = order[np.repeat(n > 1, n)]
            pick, multi = order[head], (n > 1).astype(np.uint8)
        if len(again):
            local.append((at[again], np.ones(len(again), np.int64)))
        part = _part(h1[pick], parts)
        yield from S.by_part(shard.shard, part, np.argsort(part, kind="stable"),
                             [h1[pick], h2[pick], at[pick].astype(np.uint32), ids[pick], start[pick].astype(np.uint32), multi], "W")


def _joined(s0, s1):
    """Adjacent runs as one."""
    cut = np.flatnonzero(s0[1:] != s1[:-1] + 1) + 1
    for a, b in zip(np.append(0, cut), np.append(cut, len(s0))):
        yield int(s0[a]), int(s1[b - 1])


def suffix_order(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in the order of their first ``length`` bytes, and a group number equal for equal strings.

    Prefix doubling over the bytes of ``text``; only unresolved positions are sorted again."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    size = min(8, length)
    for j in range(size):
        key = (key << np.uint64(8)) | padded[j:j + n]
    rank = np.zeros(n + length + 1, np.int64)
    sa = np.argsort(key)
    key, slots = key[sa], np.arange(n)
    while True:
        head = np.append(True, key[1:] != key[:-1])
        where = np.flatnonzero(head)
        rank[sa[slots]] = np.repeat(slots[where], np.diff(np.append(where, len(slots)))) + 1
        slots = slots[~(head & np.append(head[1:], True))]
        step = min(size, length - size)  # the last step overlaps, so that exactly ``length`` bytes count
        if not step or not len(slots):
            break
        at = sa[slots]
        key = (rank[at] << 32) | rank[at + step]
        order = np.argsort(key, kind="stable")
        sa[slots], key = at[order], key[order]
        size += step
    order = starts[np.argsort(rank[starts], kind="stable")]
    return order, rank[order]


def previous_factors(order: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(later positions, their earlier equal positions) from the suffix order.

    The previous and the next smaller position in suffix order hold the longest previous factor;
    it reaches the full length where that neighbour is of the same group."""
    n = len(order)
    later, source = [], []
    for step in (-1, 1):
        near = np.arange(n) + step
        open_ = np.flatnonzero((near >= 0) & (near < n))
        done = np.full(n, -1)
        while len(open_):
            q = near[open_]
            same = group[q] == group[open_]
            smaller = same & (order[q] < order[open_])
            done[open_[smaller]] = q[smaller]
            open_ = open_[same & ~smaller]
            # a larger neighbour's own smaller one, if known, saves the steps between
            q = near[open_]
            near[open_] = np.where(done[q] >= 0, done[q], q + step)
            open_ = open_[(near[open_] >= 0) & (near[open_] < n)]
        found = np.flatnonzero(done >= 0)
        later.append(order[found])
        source.append(order[done[found]])
    return np.concatenate(later), np.concatenate(source)


def _compare(length: int, keep_first: bool):
    """Answers of one part: runs of repeated windows for every shard."""
    def fn(rows: list[tuple]):
        for shard, kind, blob in rows:
            if kind == "L":
                yield shard, "R", blob
        if w := [r for r in rows if r[1] == "W"]:
            yield from _compare_windows(w, keep_first)
        if c := [r for r in rows if r[1] == "C"]:
            yield from _compare_contexts(c, length, keep_first)

    return fn


def _compare_windows(rows, keep_first):
    got = [S.expand(b, [np.uint64, np.uint32, np.uint32, np.int64, np.uint32, np.uint8]) for _, _, b in rows]
    h1, h2, idx, ids, start, multi = (np.concatenate(c) for c in zip(*got))
    owner = np.repeat(np.arange(len(rows)), [len(x[0]) for x in got])
    order = np.lexsort((start, ids, h2, h1))
    x, y = h1[order], h2[order]
    head = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    n = np.diff(np.append(head, len(order)))
    if keep_first:
        lead = order[np.repeat(head, n)]
        chosen = order[(ids[order] != ids[lead]) | (start[order] != start[lead])]
    else:
        chosen = order[np.repeat((n > 1) | (np.maximum.reduceat(multi[order], head) > 0), n)]
    for s, i in _by_owner(owner[chosen], idx[chosen]):
        yield rows[s][0], "R", S.squeeze([i, np.ones(len(i), np.uint32)])


def _by_owner(owner, *cols):
    order = np.argsort(owner, kind="stable")
    o = owner[order]
    cuts = np.flatnonzero(np.diff(o)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(o)]):
        if b > a:
            yield (int(o[a]), *[c[order[a:b]] for c in cols])


def _compare_contexts(rows, length, keep_first):
    heads, texts = [], []
    for _, _, blob in rows:
        size = int.from_bytes(blob[:4], "little")
        head = S.expand(blob[4:4 + size], _C_TYPES)
        body = zstandard.ZstdDecompressor().decompressobj().decompress(blob[4 + size:])
        heads.append(head)
        at = 0
        for n in head[4].tolist():
            texts.append(body[at:at + n + length - 1])
            at += n + length - 1
    g, ids, start, s0, n, multi = (np.concatenate(c) for c in zip(*heads))
    owner = np.repeat(np.arange(len(rows)), [len(h[0]) for h in heads])
    order = np.lexsort((start, ids, g))
    out = []  # (owner, first window, windows)
    batch, held = [], 0
    edges = np.append(np.flatnonzero(np.append(True, g[order][1:] != g[order][:-1])), len(order))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        group: dict[bytes, list[int]] = {}
        for i in order[a:b].tolist():
            group.setdefault(texts[i], []).append(i)
        for same in group.values():
            if keep_first:
                low = (ids[same[0]], start[same[0]])
                out += [(owner[i], s0[i], n[i]) for i in same if (ids[i], start[i]) > low]
            elif len(same) > 1 or multi[same[0]]:
                out += [(owner[i], s0[i], n[i]) for i in same]
        if len(group) > 1:
            batch.append(group)
            held += sum(map(len, group))
            if held >= ARRAY_BYTES:
                out += _array(batch, owner, s0, n, ids, start, length, keep_first)
                batch, held = [], 0
    if batch:
        out += _array(batch, owner, s0, n, ids, start, length, keep_first)
    if out:
        cols = [np.array(c) for c in zip(*out)]
        for s, x, k in _by_owner(*cols):
            yield rows[s][0], "R", S.squeeze([x.astype(np.uint32), k.astype(np.uint32)])


def _array(batch, owner, s0, n, ids, start, length, keep_first):
    """One suffix array over the different stretches of some minimisers, earlier documents first."""
    members = sorted(((ids[v[0]], start[v[0]], t, v) for group in batch for t, v in group.items()), key=lambda m: m[:2])
    text = np.frombuffer(b"".join(m[2] for m in members), np.uint8)
    sizes = np.array([len(m[2]) for m in members])
    begin = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    starts = np.repeat(begin, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    later, source = previous_factors(*suffix_order(text, starts, length))
    mask = np.zeros(len(text), bool)
    if keep_first:
        # an equal window of the same id and place is a repeated row, not an earlier one
        m1, m2 = np.searchsorted(begin, later, "right") - 1, np.searchsorted(begin, source, "right") - 1
        place = [np.array([m[k] for m in members]) for k in (0, 1)]
        strict = (place[0][m1] != place[0][m2]) | (place[1][m1].astype(np.int64) + later - begin[m1] != place[1][m2].astype(np.int64) + source - begin[m2])
        mask[later[strict]] = True
    else:
        mask[later] = True
        mask[source] = True
    out = []
    for a, b in zip(*S.runs(mask)):
        while a < b:  # runs end with their stretch
            k = int(np.searchsorted(begin, a, "right") - 1)
            e = min(b, int(begin[k] + windows[k]))
            out += [(owner[i], s0[i] + int(a - begin[k]), e - a) for i in members[k][3]]
            a = e if e < b else b
    return out


def _finish(length: int, texts: bool):
    def fn(shard: S.Shard, answers: list[bytes]):
        starts, n = S.read_answers(answers, "R", [np.uint32, np.uint32])
        gone = S.cover(starts.astype(np.int64), n.astype(np.int64) + length - 1, len(shard.data))
        data = np.frombuffer(shard.data, np.uint8)
        for i, (b, size) in enumerate(zip(shard.begin.tolist(), shard.sizes.tolist())):
            m = gone[b:b + size]
            removed = int(m.sum())
            kept = data[b:b + size][~m].tobytes() if removed else shard.data[b:b + size]
            yield (shard.id(i), size, removed, len(S.runs(m)[0]) if removed else 0, hashlib.sha256(kept).hexdigest(), kept if texts else None)

    return fn


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_first: bool = True,
          texts: bool = True, shard_bytes: int = S.SHARD_BYTES) -> DataFrame:
    """One row per document: n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes.

    A byte goes if a string of ``length`` bytes of its document that covers it also starts earlier
    (``keep_first``: smaller id, or earlier in the same document) or anywhere else (otherwise).
    Strings are bytes of the whole UTF-8 text, overlap, and are judged on the input.  Null and empty
    texts have no bytes; a null id orders last; repeated rows of one id count as one document when the
    first is kept; an empty table gives no rows.  ``length`` must be 8 or more."""
    if length < 8:
        raise ValueError("length must be 8 or more")
    shards = S.build(docs, id_col, text_col, lambda d: d, len, "repeat-shards", shard_bytes)
    few, many = S.n_parts(shards, 0.02), S.n_parts(shards, 0.25)
    grams = S.each_shard(shards, _grams(few, length), S.ENTRY, S.ENTRY_ARROW)
    known = materialise(S.each_part(grams, _repeated), "repeat-grams")
    asked = S.each_shard(S.with_answers(shards, known), _gather(many, length, keep_first), S.ENTRY, S.ENTRY_ARROW, answers=True)
    gone = materialise(S.each_part(asked, _compare(length, keep_first)), "repeat-windows")
    discard(known)
    arrow = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                       ("kept_sha256", pa.string()), ("kept", pa.binary())])
    out = S.each_shard(S.with_answers(shards, gone), _finish(length, texts),
                       "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary", arrow, answers=True)
    out = out.withColumnRenamed("id", id_col)
    return out if texts else out.drop("kept")


def brute_force(docs: list[tuple], length: int, keep_first: bool) -> list[tuple]:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) by plain comparison, for tests."""
    places: dict[bytes, list] = {}
    for d, t in docs:
        b = (t or "").encode("utf-8")
        for a in range(len(b) - length + 1):
            places.setdefault(b[a:a + length], []).append((d, a))
    rows = []
    for d, t in docs:
        b = (t or "").encode("utf-8")
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - length + 1):
            at = places[b[a:a + length]]
            if min(at) < (d, a) if keep_first else len(at) > 1:
                gone[a:a + length] = True
        kept = bytes(x for x, m in zip(b, gone) if not m)
        rows.append((d, len(b), int(gone.sum()), len(S.runs(gone)[0]), hashlib.sha256(kept).hexdigest()))
    return rows
