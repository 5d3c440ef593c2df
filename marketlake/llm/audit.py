"""Operator 13: which filters remove which documents, in every order, with a counting-Bloom duplicate prepass.

Pass one reads the texts once and keeps a light row per document: its part, the mask of the filters it fails and
two hashes of its text.  Tasks count those hashes into counting-Bloom cells; the merged sketch clears every text with
a cell that only one row touched, as such a text is certainly unique.  Only the others are read again and
shuffled, by their full text, for the smallest id of each.  Flags and labels then add up to counts per
part and mask, from which all orders follow by a product with a fixed matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, materialise, tune

#: Cells per document and cells that a text touches; a unique text is taken for a repeat with a chance of 3 %.
CELLS, HASHES = 8, 3
#: Cells of one block of the sketch (a power of two), merged by one group.
BLOCK_CELLS = 1 << 22
#: Bytes of one sketch (a bit a cell once merged), broadcast; more documents are taken in several hash ranges.
SKETCH_BYTES = 64 << 20
#: Hashes that a task counts at a time.
_CHUNK = 1 << 20

#: The filters' letters, in the order of their mask bits.
LETTERS = "ABCDE"


def flags() -> dict[str, Column]:
    """Failure conditions A to D over a column ``t`` that is not null."""
    words = F.array_remove(F.split("t", r"[\x20\x09-\x0D]+", -1), "")
    capitals = F.octet_length(F.regexp_replace("t", "[^A-Z]+", ""))
    return {"A": F.size(words) < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            "C": 100 * capitals > 2 * F.length("t"), "D": F.col("t").rlike("[#$%&*|]")}


def cells(h: np.ndarray, blocks: int, size: int = BLOCK_CELLS) -> np.ndarray:
    """(hashes, HASHES) cell numbers: all cells of one hash lie in one of the blocks of ``size`` cells."""
    u = h.view(np.uint64)
    mixed = (u ^ (u >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    block = ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    step = (u >> np.uint64(17)) | np.uint64(1)
    inner = (u[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(size - 1)
    return (block[:, None] * np.uint64(size) + inner).astype(np.int64)


def sketch(hashes: DataFrame, blocks: int, cell_count: int = BLOCK_CELLS) -> np.ndarray:
    """The merged sketch of a frame of one long column: for every cell a bit that says "two rows or more".

    Tasks send each touched cell once, with a count that stops at two; one block's cells meet in one group."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False))
            size += b.num_rows
            if size >= _CHUNK:
                yield _partial(np.concatenate(held), blocks, cell_count)
                held, size = [], 0
        if size:
            yield _partial(np.concatenate(held), blocks, cell_count)

    def merge(t: pa.Table) -> pa.Table:
        total = np.zeros(cell_count, np.uint8)
        for once, blob in zip(t.column("once").to_pylist(), t.column("cells").to_pylist()):
            at = np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(blob), np.uint32), dtype=np.int64)
            total[at] = np.minimum(total[at] + (1 if once else 2), 2)
        return pa.table({"block": t.column("block").slice(0, 1), "bits": pa.array([np.packbits(total >= 2).tobytes()], pa.binary())})

    partial = hashes.mapInArrow(count, "block int, once boolean, cells binary")
    out = np.zeros(blocks * cell_count // 8, np.uint8)
    for r in partial.groupBy("block").applyInArrow(merge, "block int, bits binary").toLocalIterator():  # SKETCH_BYTES in all
        out[r["block"] * cell_count // 8:(r["block"] + 1) * cell_count // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _partial(h: np.ndarray, blocks: int, cell_count: int) -> pa.RecordBatch:
    """Touched cells per block as sorted differences, those of one row apart from those of more."""
    at, n = np.unique(np.sort(cells(h, blocks, cell_count), 1).reshape(-1), return_counts=True)
    rows = []
    for once in (True, False):
        mine = at[(n == 1) == once]
        block = mine // cell_count
        cuts = np.flatnonzero(np.diff(block)) + 1
        for piece in np.split(mine, cuts) if len(mine) else []:
            inner = np.diff(piece % cell_count, prepend=0).astype(np.uint32)
            rows.append((int(piece[0]) // cell_count, once, zstandard.ZstdCompressor(level=1).compress(inner.tobytes())))
    types = (pa.int32(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["block", "once", "cells"])


def maybe_repeated(bits, blocks: int, cell_count: int = BLOCK_CELLS) -> Callable:
    """A column function: False for hashes of texts that are certainly unique."""
    @F.pandas_udf("boolean")
    def probe(h: pd.Series) -> pd.Series:
        at = cells(h.to_numpy(np.int64), blocks, cell_count)
        return pd.Series(((bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1))

    return probe


def masks(docs: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
          sketch_bytes: int = SKETCH_BYTES, cell_count: int = BLOCK_CELLS) -> DataFrame:
    """One light row per document: doc_id, part and mask (bits of LETTERS, E with the text's smallest id elsewhere).

    Null texts are empty, null parts the empty string.  A null id is never smaller or larger than another: such a
    row never fails E nor makes others fail it; repeated rows of one id don't make each other fail it.
    Beyond ``sketch_bytes`` * 8 / CELLS documents the hashes are taken in ranges, each with a sketch and a pass of its own."""
    spark = docs.sparkSession
    tune(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).alias("t")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text)
    failed = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(flags().values())), F.lit(0))
    light = source.select("doc_id", "part", failed.alias("mask"), F.xxhash64("t").alias("h"), F.unhex(F.sha2("t", 256)).alias("k"))
    light = materialise(light, "audit-flags")
    n = light.count()
    ranges = max(1, -(-n * CELLS // (sketch_bytes * 8)))
    blocks = max(1, -(-n * CELLS // ranges // cell_count))
    done = []
    for r in range(ranges):
        mine = (F.pmod("h", F.lit(ranges)) == r) & F.col("doc_id").isNotNull()
        bits = spark.sparkContext.broadcast(sketch(light.filter(mine).select("h"), blocks, cell_count))
        maybe = maybe_repeated(bits, blocks, cell_count)
        marked = materialise(light.filter(mine).withColumn("maybe", maybe("h")), "audit-marked")
        texts = source.select("doc_id", "t", F.xxhash64("t").alias("h")).filter(mine).filter(maybe("h"))
        least = texts.groupBy("t").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).filter("rows > 1")
        least = materialise(least.select(F.unhex(F.sha2("t", 256)).alias("k"), "least"), "audit-least")
        bits.destroy()
        late = F.when(F.col("doc_id") > F.col("least"), 1 << LETTERS.index("E")).otherwise(0)
        done += [marked.filter("maybe").join(least, "k", "left").select("doc_id", "part", (F.col("mask") + late).alias("mask")),
                 marked.filter("NOT maybe").select("doc_id", "part", "mask")]
    out = light.filter("doc_id IS NULL").select("doc_id", "part", "mask")
    for frame in done:
        out = out.unionByName(frame)
    return out


def counts(marked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents, good and toxic ones (``labels`` quality = 1, toxic = 1 in any row of the id) per part and mask."""
    known = labels.filter((F.col("quality") == 1) | (F.col("toxic") == 1)).groupBy(F.col(id_col).cast("long").alias("l"))
    known = known.agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    nobody = marked.filter("doc_id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    rows = marked.filter("doc_id IS NOT NULL").join(known, F.col("doc_id") == F.col("l"), "left")
    rows = rows.select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")).unionByName(nobody)
    return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def interactions(per_mask: DataFrame) -> DataFrame:
    """The effect of every filter at every step of every order, per part, zeros included."""
    orders = ["".join(p) for p in permutations(LETTERS)]
    places = [(o, s) for o in orders for s in range(1, len(LETTERS) + 1)]
    size = 1 << len(LETTERS)
    bit = np.array([1 << LETTERS.index(o[s - 1]) for o, s in places])
    before = np.array([sum(1 << LETTERS.index(x) for x in o[:s - 1]) for o, s in places])
    m = np.arange(size)
    fails, earlier = (m & bit[:, None]) > 0, (m & before[:, None]) > 0
    removed = (fails & ~earlier).astype(np.int64)
    each = [(~fails & ~earlier).astype(np.int64), removed, (fails & earlier).astype(np.int64), (m == bit[:, None]).astype(np.int64)]
    same = (bit[:, None] == bit).astype(np.int64)
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in MEASURES)
    n = len(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, entries in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c = np.zeros((3, size), np.int64)
                for e in entries:
                    c[:, e["mask"]] = e["n"], e["good"], e["toxic"]
                cols = [w @ c[0] for w in each] + [removed @ c[1], removed @ c[2]]
                cols.append(same @ cols[1])
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.string()), pa.array([o for o, _ in places]), pa.array([s for _, s in places], pa.int32()),
                                                  *[pa.array(x, pa.int64()) for x in cols]], ["part", "filter_order", "step", *MEASURES])

    grouped = per_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("e"))  # 32 entries at most
    return grouped.mapInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """One row per part, order of the five filters and step, with additive counts.

    Filters (a document goes at the first that it fails): A under 200 words, B less than half of the words distinct,
    C more than 2 % capitals, D any of ``#$%&*|``, E a text of a smaller id.  An empty table gives no rows; see
    ``masks`` for nulls, repeated rows and ``sizes``; columns other than those named are ignored."""
    marked = masks(docs, part_col, id_col, text_col, **sizes)
    per_mask = materialise(counts(marked, labels, id_col), "audit-counts")
    return interactions(per_mask)


#: The same in DuckDB SQL over the tables documents and labels.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
failed AS (
  SELECT doc_id, part, (len(w) < 200)::INT AS a, (100 * len(list_distinct(w)) < 50 * len(w))::INT AS b,
    (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT AS c, regexp_matches(t, '[#$%&*|]')::INT AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS e FROM words),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
per_mask AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failed LEFT JOIN known USING (doc_id) GROUP BY ALL),
letters(x, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM letters p, letters q, letters r, letters s, letters u
  WHERE p.bit + q.bit + r.bit + s.bit + u.bit = 31 AND len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
steps AS (
  SELECT filter_order, step::INT AS step, l.bit, coalesce((SELECT sum(k.bit) FROM letters k WHERE strpos(filter_order, k.x) < step), 0)::INT AS before
  FROM orders, range(1, 6) g(step), letters l WHERE l.x = filter_order[step]),
effect AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & bit = 0 AND mask & before = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM per_mask, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM effect
"""
