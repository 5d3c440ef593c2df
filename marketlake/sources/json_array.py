"""SRC-1 / SRC-2: a splittable scan of large JSON arrays of objects.

A JSON document is normally one task, whatever its size, because the meaning of a byte depends on all bytes before
it (nesting, inside a string or not).  Here a file is read as text with the separator ``}``, which every element
holds however the array is laid out, and which Spark can split at any byte.  It is read twice:

1. every split notes, for both possible starts (inside a string or not), how it changes the nesting and whether it flips
   the string state; running sums of those notes over a file (one tiny row a split) give the true state at each split's start;
2. with it, every split is cut at the commas between elements, a few MB at once; an element that spans splits is put together
   again, and Spark's own parser turns each element into a row.

Both readings hold one batch of text at a time, so a task's memory does not depend on the size of a split or a file.

A body that is not one array of objects fails the read: an object, a truncated or an empty file, text behind the array,
an element that is no object, a comma too many.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from ..storage import file_sizes

SEPARATOR = "}"
#: Bytes of text that are cut at once; one longer piece (text without the separator) makes a longer segment.
SEGMENT_BYTES = 4 << 20

_ESCAPE = re.compile(rb"\\.", re.S)
_BLANK = b" \t\r\n"


class NotAnArray(ValueError):
    """A landed body is not one JSON array."""


def structure(body: bytes, in_string: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """(bytes, nesting after each byte relative to the start, inside a string at the end); bytes within strings count as blanks."""
    buf = np.frombuffer(_ESCAPE.sub(b"..", body) if b"\\" in body else body, np.uint8)
    quote = buf == 0x22
    inside = np.logical_xor.accumulate(quote) ^ in_string
    seen = np.where(inside | quote, np.uint8(0x20), buf)
    step = ((seen == 0x7B) | (seen == 0x5B)).astype(np.int8) - ((seen == 0x7D) | (seen == 0x5D)).astype(np.int8)
    return seen, np.cumsum(step, dtype=np.int64), bool(inside[-1])


def _segments(batches: Iterator[pa.RecordBatch], segment_bytes: int) -> Iterator[tuple[tuple, bool, bytes]]:
    """(row, new split, text): the text of every split in order, with its separators, and the other columns of its rows."""
    key = None
    for b in batches:
        path, start = (b.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in (1, 2))
        edges = [0, *(np.flatnonzero((path[1:] != path[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), b.num_rows]
        for x, y in zip(edges, edges[1:]):
            if x == y:
                continue
            row = tuple(c[x].as_py() for c in b.columns[1:])
            pieces, size = [], 0
            for i, text in enumerate(b.column(0).slice(x, y - x).to_pylist(), x + 1):
                pieces.append(text)
                size += len(text) + 1
                if size >= segment_bytes or i == y:
                    yield row, key != row[:2], "".join(p + SEPARATOR for p in pieces).encode("utf-8")
                    key, pieces, size = row[:2], [], 0


_NOTES = "path string, start long, size long, bytes long, flips int, outside long, inside long"


def _notes(segment_bytes: int):
    schema = pa.schema([("path", pa.string()), *((c, pa.int64()) for c in ("start", "size", "bytes")), ("flips", pa.int32()), ("outside", pa.int64()), ("inside", pa.int64())])

    def note(row, n, state, delta):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*row, n, int(state[0]), *delta), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, state, delta = None, 0, [], []
        for row, new, body in _segments(batches, segment_bytes):
            if new:
                if at:
                    yield note(at, n, state, delta)
                at, n, state, delta = row, 0, [False, True], [0, 0]
            n += len(body)
            for i in (0, 1):
                _, nesting, state[i] = structure(body, state[i])
                delta[i] += int(nesting[-1])
        if at:
            yield note(at, n, state, delta)

    return run


def _fail(path: str, why: str):
    raise NotAnArray(f"Malformed JSON array {path}: {why}")


def _cut(segment_bytes: int):
    """Elements of every split: whole ones, and at its edges ``head`` and ``tail``, or ``middle`` if it has no cut."""
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("text", pa.string())])

    def batch(row, kinds, texts):
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([row[0]] * n, [row[1]] * n, kinds, texts), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = held = None  # the segment before waits until it is known whether it is its split's last
        for row, new, body in _segments(batches, segment_bytes):
            if at:
                yield from cut(at, held, new)
            if new:
                at = _Split(row)
            held = body
        if at:
            yield from cut(at, held, True)

    def cut(at: _Split, body: bytes, final: bool) -> Iterator[pa.RecordBatch]:
        path, last = at.row[0], final and at.last
        if last and at.unclosed:
            body = body[:-1]  # no separator follows the last piece
        begin, end = 0, len(body)
        if at.first:
            at.first = False
            body = body.removeprefix(b"\xef\xbb\xbf")
            begin, end = len(body) - len(body.lstrip(_BLANK)) + 1, len(body)
            if body[begin - 1:begin] != b"[":
                _fail(path, "does not start with [")
        if last:
            end = len(body.rstrip(_BLANK)) - 1
            if end < begin or body[end:end + 1] != b"]":
                _fail(path, "does not end with ]")
        seen, depth, in_string = structure(body, at.in_string)
        depth += at.depth
        if last and (depth[end] != 0 or seen[end] != 0x5D):
            _fail(path, "is cut off, or its brackets do not match")
        if (depth[begin:end] < 1).any():
            _fail(path, "holds more than one value")
        at.in_string, at.depth = in_string, int(depth[-1])
        cuts = (np.flatnonzero((seen[begin:end] == 0x2C) & (depth[begin:end] == 1)) + begin).tolist()
        if cuts:
            texts = [b"".join([*at.open, body[begin:cuts[0]]]), *(body[x + 1:y] for x, y in zip(cuts, cuts[1:]))]
            yield batch(at.row, ["whole" if at.cut else "head", *["whole"] * (len(texts) - 1)], [t.decode("utf-8") for t in texts])
            at.cut, at.open, begin = True, [], cuts[-1] + 1
        at.open.append(body[begin:end])
        if final:
            yield batch(at.row, ["tail" if at.cut else "middle"], [b"".join(at.open).decode("utf-8")])

    return run


class _Split:
    """A split being cut: the state before its next segment, and the text since its last cut."""

    def __init__(self, row: tuple):
        self.row, (self.in_string, self.depth, self.first, self.last, self.unclosed) = row, row[2:]
        self.cut, self.open = False, []
        if self.depth is None:
            raise RuntimeError(f"the splits of {row[0]} changed between its two readings")


@contextmanager
def _same_splits(spark: SparkSession):
    """Splits depend on the number of cores, which may change between two readings: name it for both."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
    spark.conf.set(name, before or str(cores))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def array_elements(spark: SparkSession, pattern: str | list[str], segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """(path, text): the elements of the JSON arrays of all files of a pattern, as JSON text.

    The elements are written once under ``spark.checkpoint.dir``; a file without elements (``[]``) gives no rows."""
    if empty := [p for p, size in file_sizes(spark, pattern) if not size]:
        raise NotAnArray(f"Malformed JSON array {empty[0]}: is empty")
    pieces = spark.read.option("lineSep", SEPARATOR).text(pattern)
    pieces = pieces.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))
    with _same_splits(spark):
        notes = materialise(pieces.mapInArrow(_notes(segment_bytes), _NOTES), "json-notes")
        # running sums over a file's splits: rows of a few bytes each, one per split of many MB
        over = "(PARTITION BY path ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        state = notes.select("path", "start", "outside", "inside", F.expr(f"coalesce(sum(flips) OVER {over}, 0) % 2 = 1").alias("in_string"),
                             F.expr("lag(start) OVER (PARTITION BY path ORDER BY start) IS NULL").alias("first"),
                             F.expr("lead(start) OVER (PARTITION BY path ORDER BY start) IS NULL").alias("last"),
                             # a separator too many was counted, unless the file ends with one; Hadoop drops a byte order mark
                             F.expr("sum(bytes) OVER (PARTITION BY path) - size IN (1, -2)").alias("unclosed"))
        depth = F.expr(f"coalesce(sum(if(in_string, inside, outside)) OVER {over}, 0)").alias("depth")
        state = state.select("path", "start", "in_string", depth, "first", "last", "unclosed")
        # the broadcast keeps the order of a split's pieces
        parts = pieces.drop("size").join(F.broadcast(state), ["path", "start"], "left").select("value", "path", "start", "in_string", "depth", "first", "last", "unclosed")
        parts = materialise(parts.mapInArrow(_cut(segment_bytes), "path string, start long, kind string, text string"), "json-elements")
    # the text between a split's last cut and the next one's first is one element
    group = "count_if(kind = 'tail') OVER (PARTITION BY path ORDER BY start, kind)"
    edges = parts.where("kind <> 'whole'").withColumn("group", F.expr(group))
    joined = edges.groupBy("path", "group").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))), lambda e: e["text"])).alias("text"))
    blank = F.trim(F.translate("text", "\t\r\n", "   ")) == ""
    lone = F.count(F.lit(1)).over(Window.partitionBy("path")) == 1  # no cut in the whole file
    joined = joined.withColumn("lone", lone).where(~(blank & F.col("lone"))).select("path", "text")
    return parts.where("kind = 'whole'").select("path", "text").unionByName(joined)


def read_array(spark: SparkSession, pattern: str | list[str], schema: T.StructType, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Rows of ``schema`` and ``_path``, one per element; an element that is no object or does not parse fails the read."""
    elements = array_elements(spark, pattern, segment_bytes)
    text = F.trim(F.translate("text", "\t\r\n", "   "))
    row = F.from_json("text", schema, {"mode": "FAILFAST"})
    row = F.when(text.startswith("{"), row).otherwise(F.raise_error(F.concat(F.lit("Malformed JSON array: no object in "), "path")))
    return elements.select(row.alias("row"), F.col("path").alias("_path")).select("row.*", "_path")
