"""Whole texts in shards, and hash entries that travel between shards and hash ranges.

A shard is one row with a few megabytes of whole texts, so every step over it is vectorised
and every task has the same amount of work whatever the texts hold.  Entries of a shard are
grouped by hash range ("part") into compact blobs; a part sees each hash once per shard, so a
passage that all documents share costs a part one entry per shard.  Answers go back to shards.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import materialise

#: Text bytes of a shard; one longer document makes a longer shard.
SHARD_BYTES = 4 << 20
#: Entries that one part should hold.
PART_ENTRIES = 2_000_000

_SHARD = "shard long, n_units long, ids binary, nulls binary, tags binary, sizes binary, data binary"
_SHARD_ARROW = pa.schema([("shard", pa.int64()), ("n_units", pa.int64()), ("ids", pa.binary()),
                          ("nulls", pa.binary()), ("tags", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary())])


class Shard:
    """One decoded shard: texts back to back, in the order of their document ids."""

    def __init__(self, row: dict):
        self.shard = row["shard"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.tags = np.frombuffer(row["tags"], np.int64)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, int(self.sizes.sum())))
        self.begin = np.cumsum(self.sizes) - self.sizes

    def texts(self) -> list[bytes]:
        return [self.data[b:b + n] for b, n in zip(self.begin.tolist(), self.sizes.tolist())]

    def id(self, i: int) -> int | None:
        return None if self.nulls[i] else int(self.ids[i])


def build(docs: DataFrame, id_col: str, text_col: str, normal: Callable[[bytes], bytes], units: Callable[[bytes], int],
          purpose: str, shard_bytes: int = SHARD_BYTES, tag_col: str | None = None) -> DataFrame:
    """Write the texts (null as empty, after ``normal``) as a table of shards.

    A missing id orders last; ``n_units`` sums ``units(text)``; ``tag_col`` (a long) goes along."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        task, seq = TaskContext.get().partitionId(), 0

        def flush(held):
            nonlocal seq
            held.sort(key=lambda x: x[0])
            ids = np.array([x[0] for x in held], np.int64)
            row = [(task << 32) + seq, sum(x[3] for x in held), ids.tobytes(), np.array([x[2] for x in held], bool).tobytes(),
                   np.array([x[4] for x in held], np.int64).tobytes(), np.array([len(x[1]) for x in held], np.int64).tobytes(), pack(b"".join(x[1] for x in held))]
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _SHARD_ARROW.types)], schema=_SHARD_ARROW)

        held, size = [], 0
        for b in batches:
            for i, t, tag in zip(*(c.to_pylist() for c in b.columns)):
                data = normal((t or "").encode("utf-8"))
                held.append((2**63 - 1 if i is None else i, data, i is None, units(data), tag))
                size += len(data) + 16
                if size >= shard_bytes:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    frame = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), F.col(tag_col) if tag_col else F.lit(0).cast("long"))
    frame = frame.mapInArrow(run, _SHARD)
    return materialise(frame, purpose)


def n_parts(shards: DataFrame, share: float = 1.0) -> int:
    """Parts for about ``share`` entries per unit."""
    total = shards.agg(F.coalesce(F.sum("n_units"), F.lit(0))).first()[0]
    return max(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total * share / PART_ENTRIES), 1)


def squeeze(columns: list[np.ndarray]) -> bytes:
    """Equal-length integer arrays as one blob; each is stored in byte planes."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, c.itemsize).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def expand(blob: bytes, types: list) -> list[np.ndarray]:
    """The arrays of ``squeeze``."""
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(blob)
    n = len(raw) // sum(np.dtype(t).itemsize for t in types)
    out, at = [], 0
    for t in types:
        w = np.dtype(t).itemsize
        planes = np.frombuffer(raw, np.uint8, n * w, at).reshape(w, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(t))
        at += n * w
    return out


ENTRY = "part int, shard long, kind string, blob binary"
ENTRY_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("kind", pa.string()), ("blob", pa.binary())])


def by_part(shard: int, part: np.ndarray, order: np.ndarray, columns: list[np.ndarray], kind: str) -> Iterator[tuple]:
    """Rows of ENTRY: the entries of each part, which ``order`` sorts by part."""
    sorted_part = part[order]
    cuts = np.flatnonzero(np.diff(sorted_part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)]):
        if b > a:
            yield int(sorted_part[a]), shard, kind, squeeze([c[order[a:b]] for c in columns])


def entry_batches(rows: Iterator[tuple], size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[3]) + 64
        if n >= size:
            yield _entries(held)
            held, n = [], 0
    if held:
        yield _entries(held)


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ENTRY_ARROW.types)], schema=ENTRY_ARROW)


def each_shard(frame: DataFrame, fn: Callable[[Shard, list[bytes]], Iterator[tuple]], schema: str, arrow: pa.Schema,
               answers: bool = False) -> DataFrame:
    """``fn(shard, answer blobs)`` over every shard; yields rows of ``schema``."""
    cols = ["shard", "n_units", "ids", "nulls", "tags", "sizes", "data", *(["answers"] if answers else [])]

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                held, n = [], 0
                for r in fn(Shard(row), row.get("answers") or []):
                    held.append(r)
                    n += sum(len(x) if isinstance(x, (bytes, str)) else 8 for x in r)
                    if n >= 2 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), arrow.types)], schema=arrow)
                        held, n = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), arrow.types)], schema=arrow)

    return frame.select(*cols).mapInArrow(run, schema)


ANSWER = "shard long, kind string, blob binary"
ANSWER_ARROW = pa.schema([("shard", pa.int64()), ("kind", pa.string()), ("blob", pa.binary())])


def each_part(entries: DataFrame, fn: Callable[[list[tuple]], Iterator[tuple]]) -> DataFrame:
    """``fn(rows of one part: (shard, kind, blob))`` gives rows of ANSWER."""
    def run(t: pa.Table) -> pa.Table:
        rows = list(zip(t.column("shard").to_pylist(), t.column("kind").to_pylist(), t.column("blob").to_pylist()))
        out = list(fn(rows))
        cols = zip(*out) if out else ([], [], [])
        return pa.Table.from_arrays([pa.array(c, ty) for c, ty in zip(cols, ANSWER_ARROW.types)], schema=ANSWER_ARROW)

    return entries.groupBy("part").applyInArrow(run, ANSWER)


def with_answers(shards: DataFrame, answers: DataFrame) -> DataFrame:
    """Every shard with the blobs that came back to it (kind byte in front of each)."""
    per = answers.groupBy("shard").agg(F.collect_list(F.concat(F.encode("kind", "utf-8"), "blob")).alias("answers"))
    return shards.join(per, "shard", "left")


def read_answers(answers: list[bytes], kind: str, types: list) -> list[np.ndarray]:
    """All arrays of the answers of one kind, concatenated."""
    found = [expand(a[1:], types) for a in answers if a[:1] == kind.encode()]
    if not found:
        return [np.empty(0, t) for t in types]
    return [np.concatenate(c) for c in zip(*found)]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def cover(starts: np.ndarray, lens: np.ndarray | int, n: int) -> np.ndarray:
    """True for every position in [start, start + len) of any run."""
    delta = np.bincount(starts, minlength=n + 1)[:n + 1] - np.bincount(starts + lens, minlength=n + 1)[:n + 1]
    return np.cumsum(delta[:n]) > 0
