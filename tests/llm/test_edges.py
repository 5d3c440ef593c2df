"""Every operator on one odd table: null id, null and empty text, a very long text, repeated rows,
and extra columns with names that the operators use themselves."""

import random

import public_tokenizers
import pytest

from marketlake.llm import bpe, decontam, extract, langid, minhash, quality, repeats, substrings, toxicity

rng = random.Random(4)
WORDS = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
LONG = " ".join(rng.choice(WORDS) for _ in range(60_000))       # about 400,000 bytes
TEXT = " ".join(rng.choice(WORDS) for _ in range(120))
ROWS = [(1, TEXT), (2, TEXT), (2, TEXT), (None, TEXT), (3, None), (4, ""), (5, LONG), (6, "x"), (7, "\n \t"), (8, LONG + " tail"), (9, "é🙂\x00\x1f end")]
NAMES = ("ids", "tag", "shard", "kept", "n", "rep", "bucket", "score", "spans", "i", "t", "y", "part", "blob", "h")


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in NAMES)
    return spark.createDataFrame([(i, t, *["z"] * len(NAMES)) for i, t in ROWS], schema).repartition(3)


def _by_id(df, *cols):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in cols))
    return out


def test_minhash(docs):
    got = _by_id(minhash.near_duplicates(docs), "component_id", "kept")
    assert got[1] == [(1, True)] and got[2] == [(1, False)] * 2 and got[8] == [(5, False)] and got[None] == [(1, False)]
    assert got[3] == [(3, True)] and got[4] == [(4, True)] and got[7] == [(7, True)] and len(got[9]) == 1


def test_substrings(docs):
    got = _by_id(substrings.dedup(docs, texts=False), "n_words", "n_removed")
    assert got[1] == [(120, 0)] and got[2] == [(120, 120)] * 2 and got[None] == [(120, 120)]
    assert got[5] == [(60_000, 0)] and got[8] == [(60_001, 60_000)] and got[3] == got[4] == got[7] == [(0, 0)]
    kept = _by_id(substrings.clean(docs), "text")
    assert 2 not in kept and None not in kept and kept[8] == [("tail",)] and kept[7] == [("\n \t",)] and kept[3] == [(None,)]
    assert set(substrings.clean(docs).columns) == set(docs.columns)


def test_repeats(docs):
    got = _by_id(repeats.dedup(docs, texts=False), "n_bytes", "n_removed")
    size = len(TEXT)
    assert got[1] == [(size, 0)] and got[2] == [(size, size)] * 2 and got[None] == [(size, size)]
    assert got[5] == [(len(LONG), 0)] and got[8] == [(len(LONG) + 5, len(LONG))] and got[3] == got[4] == [(0, 0)]
    both = _by_id(repeats.dedup(docs, texts=False, keep_first=False), "n_removed")
    assert both[1] == [(size,)] and both[5] == [(len(LONG),)] and both[9] == [(0,)]


def test_decontamination(docs, spark):
    items = spark.createDataFrame([(1, " ".join(LONG.split()[-15:]), "q"), (2, None, "q"), (3, "", "q")], "item_id long, text string, n_hit string")
    got = _by_id(decontam.matches(docs, items), "n_words", "n_hit")
    assert got[5] == [(60_000, 15)] and got[8] == [(60_001, 15)] and got[1] == [(120, 0)] and got[3] == got[4] == [(0, 0)] and len(got[2]) == 2


def test_encoding(docs):
    out = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    assert out.count() == len(ROWS) and out.filter("NOT lossless").count() == 0


def test_models(docs):
    assert langid.identify(docs, {"en": b"the and of " * 50, "fr": b"le la et de " * 50}).count() == len(ROWS)
    assert toxicity.score(docs, toxicity.Crf()).count() == len(ROWS)
    assert quality.score(docs, quality.Ordinal([0, 1])).count() == len(ROWS)


def test_pages(spark):
    page = "<html><body><nav><a href='/'>Home</a></nav><article><h1>T</h1>" + "<p>A line of text, no more.</p>" * 20_000 + "</article></body></html>"
    got = extract.extract(spark.createDataFrame([(1, page), (2, page)], "page_id long, html string"), extractor=extract.Extractor(pages=200)).collect()
    assert [r["n_chars"] for r in got] == [len("T") + 20_000 * len("\nA line of text, no more.")] * 2
