"""Helpers shared by the training-data operators.

Column contract: an operator reads only the columns named in its arguments and
ignores all others, so extra columns never clash; where an operator hands
input columns through, a result column replaces an input column of its name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.session import scratch_path

#: Bounds of one Arrow batch; long texts make batches of few rows.
ARROW_ROWS = 1024
ARROW_BYTES = 4 << 20
#: Labelled texts count as this long at least when the number of label rows to pick is set.
SHORT_TEXT = 64

_RUNTIME = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(ARROW_BYTES),
    # a finished write frees its shuffle files; every later step reads the written table
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> None:
    """Session settings these operators rely on: small Arrow batches, early shuffle clean-up."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back: cuts lineage,
    survives lost executors and lets Spark drop the shuffle files that made it."""
    spark = df.sparkSession
    tune(spark)
    path = scratch_path(spark, purpose)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._scratch = path  # for discard()
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``materialise`` that no later frame reads."""
    path = getattr(df, "_scratch", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def held_out(id_col: str = "doc_id") -> Column:
    """True for documents whose crc32(doc_id as text) mod 3 is 1: never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def map_batches(df: DataFrame, keep: list[str], inputs: list[str], fields: list[T.StructField],
                make: Callable[[], Callable]) -> DataFrame:
    """Append columns computed in Python, one Arrow batch at a time.

    ``make()`` runs once per task and gives ``f(*lists) -> list of column lists``, called
    with the Python lists of ``inputs``.  ``keep`` columns pass through unless a new field
    has their name."""
    new = {f.name for f in fields}
    keep = [c for c in keep if c not in new]
    sent = list(dict.fromkeys([*keep, *inputs]))
    at = [sent.index(c) for c in inputs]
    out = T.StructType([*[df.schema[c] for c in keep], *fields])
    arrow_new = [to_arrow(f.dataType) for f in fields]
    names = [f.name for f in out]
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            if b.num_rows:
                cols = f(*[b.column(i).to_pylist() for i in at])
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i) for i in range(n_keep)], *[pa.array(c, t) for c, t in zip(cols, arrow_new)]], names)

    return df.select(*sent).mapInArrow(run, out)


def to_arrow(t: T.DataType) -> pa.DataType:
    simple = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.FloatType: pa.float32(),
              T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(), T.ShortType: pa.int16()}
    if isinstance(t, T.ArrayType):
        return pa.list_(to_arrow(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, to_arrow(f.dataType)) for f in t])
    return simple[type(t)]


def arrow_schema(s: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow(f.dataType)) for f in s])


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, train_bytes: int, id_col: str = "doc_id",
                    text_col: str = "text") -> tuple[list[str], list[int], list[int]]:
    """(texts, labels, all label values) of a bounded sample of whole labelled documents.

    Up to ``train_bytes`` of text of each label (4 * ``train_bytes`` of all), in the order of a hash of the id:
    a document that no longer fits is skipped, later ones that fit are still taken, and a label of which none
    fits gives its shortest document.  Label rows are picked before texts are read (their number is bounded by
    ``train_bytes``); lengths of the picked rows decide which texts are read.  Rows without a label teach nothing."""
    rows = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}  # a row a label
    if not counts:
        return [], [], []
    train_bytes = min(train_bytes, 4 * train_bytes // len(counts))
    share = F.create_map(*[v for y, n in counts.items() for v in (F.lit(y), F.lit(min(1.0, train_bytes / SHORT_TEXT / n)))])
    picked = rows.filter(F.pmod(F.xxhash64("i"), F.lit(1_000_000)) / 1_000_000 < share[F.col("y")])
    picked = picked.groupBy("i", "y").agg(F.xxhash64("i").alias("h"), F.count("*").alias("m"))  # m: ratings of one value
    texts = docs.select(F.col(id_col).alias("i"), F.coalesce(text_col, F.lit("")).alias("t")).withColumn("size", F.octet_length("t"))
    sizes = texts.select("i", "size").join(F.broadcast(picked), "i").groupBy("h", "i", "y", "size").agg(F.first("m").alias("m"), F.sum("m").alias("n"))
    sizes = sorted(tuple(r) for r in sizes.collect())
    room, taken, order = dict.fromkeys(counts, train_bytes), {}, {}
    for at, (_, i, y, size, m, n) in enumerate(sizes):
        order[i, y, size] = at
        if size <= room[y]:
            taken[i, y, size] = (m, min(n, room[y] // size if size else n))
            room[y] -= size * taken[i, y, size][1]
    for y in {r[2] for r in sizes} - {k[1] for k in taken}:
        _, i, _, size, m, _ = min((r for r in sizes if r[2] == y), key=lambda r: r[3])
        taken[i, y, size] = (m, 1)
    if not taken:
        return [], [], sorted(counts)
    spark, id_type = docs.sparkSession, texts.schema["i"].dataType
    wanted = spark.createDataFrame([(i, size, y) for i, y, size in taken],
                                   T.StructType([T.StructField("i", id_type), T.StructField("size", T.IntegerType()), T.StructField("y", T.IntegerType())]))
    found, left = [], {k: n for k, (_, n) in taken.items()}
    for i, size, t, y in texts.join(F.broadcast(wanted), ["i", "size"]).select("i", "size", "t", "y").toLocalIterator():
        k = (i, y, size)
        times = min(taken[k][0], left[k])
        left[k] -= times
        found += [(order[k], t, y)] * times
    found.sort()
    return [t for _, t, _ in found], [y for _, _, y in found], sorted(counts)
