"""The pipeline against its brute-force version, and on odd tables."""

import public_tokenizers
import tiktoken

import corpus_pipeline
from marketlake.llm import bpe, decontam, langid, minhash, queries, substrings
from marketlake.llm.common import held_out

SF = "/root/testdata/sf0.001"


def _brute(rows, dictionaries, items):
    c = langid.Compressors(dictionaries)
    rows = [r for r in rows if not c.classify(r["text"])[2]]
    kept = {r[0] for r in minhash.brute_force([(r["doc_id"], r["text"]) for r in rows], 5, 80) if r[3]}
    rows = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] in kept}
    n = {r[0]: r for r in substrings.brute_force(list(rows.items()))}
    seen, texts = set(), {}
    for d in sorted(rows):
        w, gone = rows[d].encode().split(), set()
        for a in range(len(w) - 19):
            key = tuple(w[a:a + 20])
            gone.update(range(a, a + 20) if key in seen else ())
            seen.add(key)
        assert len(gone) == n[d][2]
        if not gone:
            texts[d] = rows[d]
        elif len(gone) < len(w):
            texts[d] = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
    clean = {r[0] for r in decontam.brute_force(list(texts.items()), items) if not r[5]}
    return {d: t for d, t in texts.items() if d in clean}


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = _brute(docs.collect(), langid.learn(docs, where=~held_out()), items)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert 0 < len(want) < docs.count()
    ref = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(queries.ranks_path()), special_tokens={})
    assert all(r["lossless"] and r["n_tokens"] == len(ref.encode_ordinary(r["text"])) and r["n_chars"] == len(r["text"]) for r in got)


def test_odd_tables(spark, tmp_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_dir}/benchmark.parquet")
    rows = [(None, None, None, None, None, None), (1, "", "en", None, 0, "k"), (2, None, "en", "s", None, "k"), (3, "the cat and the dog went out " * 8, "en", "s", 1, None),
            (3, "the cat and the dog went out " * 8, "en", "s", 1, None), (5, "le chat et le chien sont " * 300, "fr", None, None, None), (6, "12 34", None, None, 5, "k")]
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, tmp_dir)
            assert set(schema.split()[::2]) <= set(table.columns), name
        out = table.collect()
        assert all(r["doc_id"] in (3, 5) for r in out)
