"""Operator 2: held-out accuracy, rejection, and the odd rows."""

import pytest
from pyspark.sql import functions as F

from marketlake.llm import langid
from marketlake.llm.common import held_out

SF = "/root/testdata/sf0.1"
EN, FR = "the cat and the dog went out of the house with this old man ", "le chat et le chien sont dans la maison avec une vieille dame "


@pytest.fixture(scope="module")
def dictionaries(spark):
    return langid.learn(spark.read.parquet(f"{SF}/documents.parquet"), where=~held_out())


def test_held_out_accuracy(spark, dictionaries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(held_out())
    got = langid.identify(docs, dictionaries, keep=["doc_id", "lang"])
    n, right, rejected = got.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred")), F.count_if("rejected")).first()
    assert right / n > 0.98 and rejected / n < 0.02


def test_dictionaries_are_bounded(dictionaries, docs_df):
    assert set(dictionaries) == {"de", "en", "es", "fr"}
    assert all(0 < len(d) <= langid.DICT_BYTES for d in dictionaries.values())
    rows = [(i, EN * 300, "en") for i in range(3)] + [(9, FR, "fr"), (10, None, "de"), (11, EN, None)]
    own = langid.learn(docs_df(rows, "doc_id long, text string, lang string"))  # long documents only, where no others exist
    assert set(own) == {"en", "fr"}


def test_foreign_passages_teach_nothing():
    rows = [("en", i, langid.fold(EN * 6) + b" ") for i in range(6)] + [("fr", i, langid.fold(FR * 6) + b" ") for i in range(6)]
    rows[1] = ("en", 1, langid.fold(FR * 6) + b" ")
    kept = langid._agreed(sorted(rows), 1 << 14)
    assert all((b"chat" in part) == (lang == "fr") for lang, _, part in kept)
    assert len({o for lang, o, _ in kept if lang == "en"}) == 5


def test_odd_rows(docs_df, dictionaries):
    texts = [None, "", "12 34 !?", "١٢", EN * 5, EN.upper() * 5, FR * 5, EN * 5, "x" * 5000]
    df = docs_df([(i, t, "zz") for i, t in enumerate(texts)] + [(None, FR * 5, None)], "doc_id long, text string, score string")
    out = langid.identify(df, dictionaries)
    assert out.columns == ["doc_id", "text", "lang_pred", "score", "rejected"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert [rows[i]["lang_pred"] for i in range(4)] == ["und"] * 4 and all(rows[i]["rejected"] for i in range(4))
    assert [rows[i]["lang_pred"] for i in (4, 5, 6, 7, None)] == ["en", "en", "fr", "en", "fr"]
    assert all(0 <= r["score"] <= 1 for r in rows.values()) and rows[4]["score"] == rows[7]["score"]


def test_without_labels(docs_df):
    none = langid.learn(docs_df([(1, EN, None)], "doc_id long, text string, lang string"))
    assert none == {}
    assert [r["lang_pred"] for r in langid.identify(docs_df([(1, EN)]), none).collect()] == ["und"]
    assert langid.identify(docs_df([]), none).count() == 0
    assert [r["rejected"] for r in langid.identify(docs_df([(1, EN)]), {"en": langid.fold(EN * 9)}).collect()] == [False]


def test_whole_texts_count(dictionaries):
    c = langid.Compressors(dictionaries)
    assert c.classify(EN * 20 + FR * 400)[0] == "fr"
