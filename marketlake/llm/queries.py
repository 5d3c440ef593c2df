"""The registered queries of the training-data operators, with production parameters.

Most of them can't be written in SQL at this size (compression, merges by rank, models, hash
functions, byte windows); ``ORACLE`` holds those that can, and tests/llm compares each of the others
with a brute-force version or held-out accuracy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import audit, bpe, collocations, decontam, embeddings, extract, langid, licenses, minhash, quality, repeats, substrings, toxicity
from marketlake.llm.common import held_out, table


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingle sets are at least 85 % similar."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by compression, learned from the rows not held out."""
    docs = table(spark, sf_dir, "documents")
    dictionaries = langid.learn(docs, where=~held_out())
    found = langid.identify(docs, dictionaries, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label with a cosine of 0.98 or more, by cross-polytope hashing."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated 20-word windows removed from every document, the first copy kept."""
    return substrings.dedup(table(spark, sf_dir, "documents"), texts=False, spans=False)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 400-byte strings that occur anywhere else removed from every document."""
    return repeats.dedup(table(spark, sf_dir, "documents"), keep_first=False, texts=False)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verbatim 10-word matches of benchmark items in every document."""
    return decontam.digest(decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected quality grade of every document, learned from the ratings not held out."""
    docs = table(spark, sf_dir, "documents")
    ratings = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out())
    model = quality.learn(docs, ratings)
    found = quality.score(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "grade", "tail_probability", "selected")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows not held out."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out())
    crf = toxicity.learn(docs, labels)
    found = toxicity.score(docs, crf, keep=["doc_id"], spans=False)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"]).select("page_id", "url", "text", "n_chars")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's encoding and of its decoding."""
    found = bpe.round_trip(table(spark, sf_dir, "documents"), ranks_path(), keep=["doc_id"])
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document, by a set-similarity join of its blocks."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of 2 to 5 words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove, at every step of every order, per source."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_dedup, op2_language_id, op3_embedding_dedup, op4_substring_dedup, op5_benchmark_decontamination,
    op6_suffix_array_dedup, op7_quality, op8_toxicity, op9_html_extraction, op10_byte_bpe, op11_license_scan,
    op12_collocations, op13_filter_audit)}
ORACLE: dict[str, str] = {"op11_license_scan": licenses.oracle(), "op12_collocations": collocations.ORACLE,
                          "op13_filter_audit": audit.ORACLE}
