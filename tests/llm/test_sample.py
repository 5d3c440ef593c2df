"""The labelled sample that operators 7 and 8 learn from."""

import pytest

from marketlake.llm import quality, toxicity
from marketlake.llm.common import labelled_sample

MANY = 300


@pytest.fixture(scope="module")
def skewed(spark, docs_df):
    """Each label: one document longer than train_bytes first, then MANY short ones."""
    docs = [(0, "moron idiot " * 2000), (1, "quiet calm " * 2000)]
    for k in range(MANY):
        docs += [(2 * k + 2, f"you idiot number {k}, moron" + " and idiot" * 10), (2 * k + 3, f"a quiet day number {k}, calm" + " and quiet" * 10)]
    return docs_df(docs).coalesce(1), docs_df([(i, 1 - i % 2) for i, _ in docs], "doc_id long, toxic int")


def test_long_document_takes_no_room(skewed):
    texts, y, values = labelled_sample(*skewed, "toxic", 5_000)
    assert values == [0, 1]
    for v in values:
        sizes = [len(t.encode()) for t, label in zip(texts, y) if label == v]
        # what is left would not hold one more short text
        assert 4_800 < sum(sizes) <= 5_000 and max(sizes) < 200


def test_sample_is_no_prefix(skewed):
    texts, _, _ = labelled_sample(*skewed, "toxic", 2_000)
    at = [int(t.split("number ")[1].split(",")[0]) for t in texts]
    assert max(at) > MANY * 0.8 and at != sorted(at)


def test_models_after_a_long_document(skewed, docs_df):
    docs, labels = skewed
    fresh = docs_df([(1, "well, you idiot"), (2, "well, a quiet day")])
    crf = toxicity.learn(docs, labels, train_bytes=8_000)
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(fresh, crf).collect()} == {1: 1, 2: 0}
    model = quality.learn(docs, labels, grade_col="toxic", train_bytes=8_000)
    got = {r["doc_id"]: r["grade"] for r in quality.score(fresh, model).collect()}
    assert got[1] > 0.5 > got[2]


def test_only_long_documents(docs_df):
    docs = docs_df([(1, "a" * 900), (2, "b" * 700), (3, "c" * 800), (4, "short")])
    labels = docs_df([(1, 0), (2, 0), (3, 0), (4, 1), (5, 2)], "doc_id long, y int")
    texts, y, values = labelled_sample(docs, labels, "y", 300)
    assert set(zip(y, texts)) == {(0, "b" * 700), (1, "short")} and values == [0, 1, 2]


def test_repeated_rows(docs_df):
    docs = docs_df([(1, "x" * 100)] * 50 + [(2, None), (2, "yy"), (None, "z")])
    labels = docs_df([(1, 0), (2, 1), (2, 1), (2, 0), (None, 1)], "doc_id long, y int")
    texts, y, _ = labelled_sample(docs, labels, "y", 1_200)
    got = sorted(zip(y, texts))
    assert [p for p in got if p[0] == 1] == [(1, ""), (1, ""), (1, "yy"), (1, "yy")]
    assert sum(len(t) for v, t in got if v == 0) <= 1_200 and got.count((0, "x" * 100)) >= 11
