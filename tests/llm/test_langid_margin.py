"""Operator 2 rejects texts in a language that it has not learned."""

from pyspark.sql import functions as F

from marketlake.llm import langid
from marketlake.llm.common import held_out

SF = "/root/testdata/sf0.1"


def test_left_out_language_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = langid.learn(docs, where=~held_out())
    some = docs.filter(held_out() & (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(10)) == 0) & F.col("text").rlike(r"\p{L}"))
    rows = [(r["lang"], r["text"]) for r in some.select("lang", "text").collect() if r["lang"] in dictionaries]
    known = langid.Compressors(dictionaries)
    assert sum(known.classify(t)[2] for _, t in rows) < 0.02 * len(rows)
    unknown = {k: langid.Compressors({x: d for x, d in dictionaries.items() if x != k}) for k in dictionaries}
    assert sum(not unknown[k].classify(t)[2] for k, t in rows) < 0.2 * len(rows)
