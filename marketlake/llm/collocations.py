"""Operator 12: phrase collocations from weighted acyclic automata.

Texts of one language are dealt into shards.  Depth by depth, each shard extends its sequences by one word and
sorts them into a count transducer (states, labels, weights); a range of prefixes then unites the shards'
transducers, sums their weights, prunes what is rarer than ``least``, numbers the states left and sends the numbers back.  A
sequence is extended only where both parts that are one word shorter survived, so each depth is small and all counts are
exact.  Parts of a phrase are looked up by composing it with the automaton from its second word on:
its prefix's path gives the counts of first parts, its suffix's path those of the rest.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import hashing as H
from marketlake.llm.automata import Arcs
from marketlake.llm.common import discard, materialise, tune
from marketlake.llm.shards import expand, squeeze

#: Text bytes of a shard (one longer document makes a longer shard).  One n-gram gives a part one entry per shard.
SHARD_BYTES = 4 << 20
#: Entries that one part should hold.
PART_ENTRIES = 2_000_000
#: Parts over which the arcs of one state are split by their label.
SPLIT = 8

#: Bytes that end a piece and bytes that end a word.
_PIECE = np.zeros(256, bool)
_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_PIECE
_WORD[[0x20, 0x09]] = False

_ENTRY = "lang string, part int, shard long, blob binary, words binary"
_ENTRY_ARROW = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("shard", pa.int64()), ("blob", pa.binary()), ("words", pa.binary())])


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, word starts, word ends, is the next word in the same piece?) over lower-cased texts."""
    buf = np.frombuffer(b"\n" + b"\n".join(texts).translate(H.LOWER) + b"\n", np.uint8)
    inside = _WORD[buf]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    stops = np.flatnonzero(_PIECE[buf])
    joined = np.searchsorted(stops, ends[:-1]) == np.searchsorted(stops, starts[1:])
    return buf, starts, ends, np.append(joined, False)[:len(starts)]


def shards(docs: DataFrame, text_col: str, lang_col: str, shard_bytes: int) -> DataFrame:
    """Written shards of one language each: words as codes of the shard's own dictionary, and where pieces end."""
    schema = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("dictionary", pa.binary()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal seq
            buf, s, e, joined = words_of(held.pop(lang))
            size.pop(lang)
            _, first, code = np.unique(H.word_hashes(buf, s, e), return_index=True, return_inverse=True)
            raw = buf.tobytes()
            words = [raw[a:b] for a, b in zip(s[first].tolist(), e[first].tolist())]
            order = np.argsort(_checksums(words), kind="stable")  # the order of parts, whatever their number
            place = np.empty(len(words), np.int32)
            place[order] = np.arange(len(words), dtype=np.int32)
            dictionary = zstandard.ZstdCompressor(level=1).compress(b"\n".join(words[i] for i in order.tolist()))
            row = ((task << 32) + seq, lang, len(s), dictionary, squeeze([place[code], joined]))
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(lang, []).append(text.encode("utf-8"))
                size[lang] = size.get(lang, 0) + len(held[lang][-1]) + 1
                if size[lang] >= shard_bytes:
                    yield flush(lang)
                elif sum(size.values()) >= 4 * shard_bytes:
                    yield flush(max(size, key=size.get))
        for lang in list(held):
            yield flush(lang)

    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("l"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return materialise(source.mapInArrow(run, "shard long, lang string, n_words long, dictionary binary, words binary"), "phrase-shards")


def _checksums(words: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words], np.uint64)


def _blobs(part: np.ndarray, order: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(part, its entries, their columns as a blob) for entries that ``order`` sorts by part."""
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for piece in np.split(order, cuts) if len(order) else []:
        yield int(part[piece[0]]), piece, squeeze([c[piece] for c in columns])


def _first_entries(parts: dict[str, int]):
    """Depth one: the distinct words of a shard, with their counts, by range of their checksum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                if r["n_words"]:
                    words = zstandard.ZstdDecompressor().decompressobj().decompress(r["dictionary"]).split(b"\n")
                    n = np.bincount(expand(r["words"], [np.int32, bool])[0], minlength=len(words))
                    part = ((_checksums(words) * np.uint64(parts[r["lang"]])) >> np.uint64(32)).astype(np.int64)
                    rows = [(r["lang"], p, r["shard"], blob, zstandard.ZstdCompressor(level=1).compress(b"\n".join(words[i] for i in piece.tolist())))
                            for p, piece, blob in _blobs(part, np.arange(len(words)), [n.astype(np.int64)])]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ENTRY_ARROW.types)], schema=_ENTRY_ARROW)

    return run


def _rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [[]] * 5
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, _ENTRY_ARROW.types)], schema=_ENTRY_ARROW)


def _unite_words(least: int):
    """One range of words: summed counts; a row of numbers for every shard and one with what survives."""
    def run(t: pa.Table) -> pa.Table:
        lang, part = t.column("lang")[0].as_py(), t.column("part")[0].as_py()
        known: dict[bytes, int] = {}
        lists = [zstandard.ZstdDecompressor().decompressobj().decompress(w).split(b"\n") for w in t.column("words").to_pylist()]
        at = [np.array([known.setdefault(w, len(known)) for w in ws], np.int64) for ws in lists]
        total = np.zeros(len(known), np.int64)
        for i, blob in zip(at, t.column("blob").to_pylist()):
            total[i] += expand(blob, [np.int64])[0]  # distinct within a shard
        good = np.flatnonzero(total >= least)
        number = np.full(len(known), -1, np.int64)
        number[good] = (part << 32) + np.arange(len(good))
        words = list(known)
        rows = [(lang, part, s, squeeze([number[i]]), None) for s, i in zip(t.column("shard").to_pylist(), at)]
        if len(good):
            rows.append((lang, part, None, squeeze([number[good], np.full(len(good), -1), number[good], total[good]]), zstandard.ZstdCompressor().compress(b"\n".join(words[i] for i in good.tolist()))))
        return _rows(rows)

    return run


def _unite(least: int):
    """One range of prefixes: the union of the shards' transducers; rows as for words."""
    def run(t: pa.Table) -> pa.Table:
        lang, part = t.column("lang")[0].as_py(), t.column("part")[0].as_py()
        united, places = Arcs.union([Arcs(*expand(b, [np.int64] * 3)) for b in t.column("blob").to_pylist()])
        number = united.numbered(least, part << 32)
        rows = [(lang, part, s, squeeze([number[i]]), None) for s, i in zip(t.column("shard").to_pylist(), places)]
        good = number >= 0
        if good.any():
            rows.append((lang, part, None, squeeze([number[good], united.state[good], united.label[good], united.weight[good]]), None))
        return _rows(rows)

    return run


class _Walk:
    """The sequences of one shard that are still alive, from depth to depth.

    ``state`` holds, for every word, the local code of the sequence that starts there (-1: none), ``word`` the code
    of the word itself; ``states`` and ``labels`` are the numbers behind those codes."""

    def __init__(self, code: np.ndarray, joined: np.ndarray, number: np.ndarray):
        self.depth, self.follows = 1, joined[:-1]
        self.state, self.states = self._alive(code, number)
        self.word, self.labels = self.state, self.states

    @staticmethod
    def _alive(code: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        good = number >= 0
        local = np.append(np.where(good, np.cumsum(good) - 1, -1), -1).astype(np.int32)  # code -1 stays -1
        return local[code], number[good]

    def entries(self, parts: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The next depth's arcs: (part, order by part, their state, label and count)."""
        self.at = np.flatnonzero((self.state[:-1] >= 0) & (self.state[1:] >= 0) & self.follows)
        arcs, self.which = Arcs.extend(self.state[self.at], self.word[self.at + self.depth])
        s, t = self.states[arcs.state], self.labels[arcs.label]
        mixed = H.mix(s.view(np.uint64)) + H.mix(t.view(np.uint64)) % np.uint64(SPLIT)
        part = (mixed % np.uint64(parts)).astype(np.int64)
        self.order = np.argsort(part, kind="stable")
        return part, self.order, [s, t, arcs.weight.astype(np.int64)]

    def advance(self, number: np.ndarray) -> None:
        """Go one depth on with the numbers of the last entries, which come in the order of their parts."""
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        arc = np.full(len(self.state), -1, np.int64)
        arc[self.at] = place[self.which]
        self.state, self.states = self._alive(arc, number)
        self.depth, self.follows = self.depth + 1, True  # both parts lie in one piece and overlap


def _next_entries(depth: int, parts: dict[str, int]):
    """Entries of ``depth``: every shard walks again through the depths before it, as it is cheaper to do so than to keep their state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                numbers: list[list[tuple[int, bytes]]] = [[] for _ in range(depth)]
                for a in r["answers"]:
                    numbers[a["depth"]].append((a["part"], a["blob"]))
                numbers = [np.concatenate([np.empty(0, np.int64), *[expand(x, [np.int64])[0] for _, x in sorted(n)]]) for n in numbers]
                walk = _Walk(*expand(r["words"], [np.int32, bool]), numbers[1])
                found = walk.entries(parts[r["lang"]])
                for n in numbers[2:]:
                    walk.advance(n)
                    found = walk.entries(parts[r["lang"]])
                rows = [(r["lang"], p, r["shard"], blob, None) for p, _, blob in _blobs(*found)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ENTRY_ARROW.types)], schema=_ENTRY_ARROW)

    return run


def _arcs_of(united: DataFrame) -> DataFrame:
    """(lang, state, prefix, label, a, word): the automaton's arcs as rows; ``word`` at depth one only."""
    schema = pa.schema([("lang", pa.string()), ("state", pa.int64()), ("prefix", pa.int64()), ("label", pa.int64()), ("a", pa.int64()), ("word", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, blob, words in zip(*(b.column(i).to_pylist() for i in range(3))):
                cols = expand(blob, [np.int64] * 4)
                n = len(cols[0])
                words = zstandard.ZstdDecompressor().decompressobj().decompress(words).decode("utf-8").split("\n") if words is not None else [None] * n
                yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), *[pa.array(c, pa.int64()) for c in cols], pa.array(words, pa.string())], schema=schema)

    return united.filter("shard IS NULL").select("lang", "blob", "words").mapInArrow(run, "lang string, state long, prefix long, label long, a long, word string")


def frequent(docs: DataFrame, longest: int = 5, least: int = 100, text_col: str = "text", lang_col: str = "lang",
             shard_bytes: int = SHARD_BYTES, part_entries: int = PART_ENTRIES) -> tuple[DataFrame, list[DataFrame]]:
    """(words per lang, arcs of every depth): the automaton of all sequences of 1 to ``longest`` words and at least ``least`` places."""
    spark = docs.sparkSession
    tune(spark)
    state = shards(docs, text_col, lang_col, shard_bytes)
    totals = materialise(state.groupBy("lang").agg(F.sum("n_words").alias("n")).filter("n > 0"), "phrase-words")
    n = {r["lang"]: r["n"] for r in totals.collect()}  # a row a language
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = {lang: max(1, math.ceil(c / part_entries), math.ceil(width * c / sum(n.values()))) for lang, c in n.items()}
    united, out = [], []
    for depth in range(1, longest + 1):
        if depth == 1:
            entries = state.mapInArrow(_first_entries(parts), _ENTRY)
        else:
            numbers = reduce(DataFrame.unionByName, [u.filter("shard IS NOT NULL").select("shard", F.lit(d).alias("depth"), "part", "blob") for d, u in enumerate(united, 1)])
            numbers = numbers.groupBy("shard").agg(F.collect_list(F.struct("depth", "part", "blob")).alias("answers"))
            walked = state.select("shard", "lang", "words").join(numbers, "shard")  # a shard without words has none
            entries = walked.mapInArrow(_next_entries(depth, parts), _ENTRY)
        unite = _unite_words(least) if depth == 1 else _unite(least)
        united.append(materialise(entries.groupBy("lang", "part").applyInArrow(unite, _ENTRY), f"phrase-united{depth}"))
        out.append(materialise(_arcs_of(united[-1]), f"phrase-arcs{depth}"))
    for frame in (state, *united):
        discard(frame)
    return totals, out


def composed(arcs: list[DataFrame]) -> list[DataFrame]:
    """Arcs of every depth with their phrase, the state of their suffix, and the counts of all first parts and rests."""
    none = F.array().cast("array<long>")
    out = [arcs[0].select("lang", "state", "prefix", "label", "a", "word", F.col("word").alias("phrase"), F.lit(-1).cast("long").alias("suffix"), none.alias("firsts"), none.alias("rests"))]
    for depth, found in enumerate(arcs[1:], 2):
        before = out[-1]
        head = before.select("lang", F.col("state").alias("prefix"), F.col("phrase").alias("p"), F.concat("firsts", F.array("a")).alias("firsts"), F.col("suffix").alias("middle"))
        tail = before.select("lang", F.col("prefix").alias("middle"), "label", F.col("state").alias("suffix"), "word", F.concat(F.array("a"), "rests").alias("rests"))
        rows = found.drop("word").join(head, ["lang", "prefix"]).join(tail, ["lang", "middle", "label"])
        out.append(materialise(rows.select("lang", "state", "prefix", "label", "a", "word", F.concat_ws(" ", "p", "word").alias("phrase"), "suffix", "firsts", "rests"), f"phrase-composed{depth}"))
    return out


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang", **sizes) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Counts are those of contiguous words within pieces (texts end at ``.,;:!?`` and line breaks), per language.  A phrase
    of 2 to ``longest`` words and at least ``least`` places is cut where floor(1000 * a * n / (l * r)) is lowest (the first such cut).
    Phrases within a longer one that is as frequent are left out: if any longer one is, one longer by a word is, as counts only fall.
    A null language is ``und``, a null text empty; document ids are not read, so repeated rows count again; ties go by
    count, then phrase; an empty table, or one without such phrases, gives no rows; other columns are ignored."""
    totals, arcs = frequent(docs, longest, least, text_col, lang_col, **sizes)
    every = composed(arcs)
    cut = F.expr("array_min(transform(sequence(1, size(firsts)), k -> struct("
                 "(CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)) * 1000BD) div (CAST(firsts[k - 1] AS DECIMAL(19,0)) * CAST(rests[k - 1] AS DECIMAL(19,0))) AS score, "
                 "k AS k, firsts[k - 1] AS l, rests[k - 1] AS r)))")
    found = None
    for depth in range(2, longest + 1):
        rows = every[depth - 1].select("lang", "state", "phrase", "a", "firsts", "rests")
        if depth < longest:
            longer = every[depth]
            cover = longer.select("lang", F.col("prefix").alias("state"), "a").unionByName(longer.select("lang", F.col("suffix").alias("state"), "a"))
            rows = rows.join(cover, ["lang", "state", "a"], "left_anti")
        found = rows if found is None else found.unionByName(rows)
    scored = found.join(totals, "lang").select("lang", "phrase", "a", "n", cut.alias("c")).select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
    best = F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")
    return scored.withColumn("rank", best.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB SQL over the table documents, with every n-gram counted.
ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{bytes(range(65, 91)).decode()}', '{bytes(range(97, 123)).decode()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, len(g) AS m, count(*) AS a
  FROM (SELECT lang, w[i:i + m - 1] AS g FROM words, range(1, 6) s(m), unnest(range(1, (len(w) - m + 2)::BIGINT)) u(i)) GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT g.lang, g.phrase, g.m, g.a, k, x.a AS l, y.a AS r, n, ((1000::HUGEINT * g.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM grams WHERE m > 1) g JOIN totals USING (lang)
  JOIN grams x ON x.lang = g.lang AND x.phrase = array_to_string(g.w[:k], ' ') JOIN grams y ON y.lang = g.lang AND y.phrase = array_to_string(g.w[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM best h WHERE h.lang = b.lang AND h.m > b.m AND 100 * h.a >= 100 * b.a AND strpos(' ' || h.phrase || ' ', ' ' || b.phrase || ' ') > 0)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
