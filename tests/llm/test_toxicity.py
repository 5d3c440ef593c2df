"""Operator 8: held-out accuracy, exact marginals, and the odd rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import toxicity
from marketlake.llm.common import held_out

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def crf(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").filter(~held_out())
    return toxicity.learn(docs, labels)


def test_held_out_accuracy(spark, crf):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(held_out()).select("doc_id", "toxic")
    got = toxicity.score(docs, crf, keep=["doc_id"], spans=False).join(labels, "doc_id")
    n = {(r["toxic"], r["predicted"]): r["n"] for r in got.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    # only some two dozen toxic documents of each smaller language are there to learn from
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.75
    assert n.get((0, 1), 0) / n[0, 0] < 0.01


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    crf = toxicity.Crf()
    crf.w = rng.normal(size=len(crf.w)).astype(np.float32)
    crf.w[0], crf.bias, crf.t = 0, 0.3, rng.normal(size=(2, 2))
    tok = toxicity.Tokens(["one two three four. five six", "", "seven"])
    emit = crf.w[tok.slots].sum(1) + crf.bias
    p, pairs, _ = crf.marginals(tok, True)
    want_p, want_pairs = np.zeros(tok.n), np.zeros((2, 2))
    for a, b in zip(tok.chains, np.append(tok.chains[1:], tok.n)):
        z, one, two = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            weight = np.exp(sum(emit[a + i] * v for i, v in enumerate(y)) + sum(crf.t[u, v] for u, v in zip(y, y[1:])))
            z += weight
            one += weight * np.array(y)
            for u, v in zip(y, y[1:]):
                two[u, v] += weight
        want_p[a:b] = one / z
        want_pairs += two / z
    assert np.allclose(p, want_p) and np.allclose(pairs, want_pairs)
    assert [int(x) for x in np.diff(np.append(tok.chains, tok.n))] == [4, 2, 1]


def test_offsets_and_odd_rows(docs_df, crf):
    rows = [(1, "Hé. You Idiot, you moron!"), (2, None), (3, ""), (4, "??"), (None, "a quiet day"), (1, "Hé. You Idiot, you moron!")]
    out = toxicity.score(docs_df([(i, t, "x") for i, t in rows], "doc_id long, text string, score string"), crf).collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == {"doc_id", "text", "score", "predicted", "spans"}
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        found = [r["text"][s["start"]:s["end"]].lower() for s in r["spans"]]
        assert found == (["idiot", "moron"] if r["doc_id"] == 1 else [])
        assert r["predicted"] == int(r["doc_id"] == 1)


def test_without_labels(docs_df):
    none = toxicity.learn(docs_df([(1, "x")]), docs_df([], "doc_id long, toxic int"))
    assert [r["predicted"] for r in toxicity.score(docs_df([(1, "idiot")]), none).collect()] == [0]
    assert toxicity.score(docs_df([]), none).count() == 0
