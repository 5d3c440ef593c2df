"""Operator 7: held-out accuracy, ordered grades, and the odd rows."""

import numpy as np
from pyspark.sql import functions as F

from marketlake.llm import quality
from marketlake.llm.common import held_out

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    ratings = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    model = quality.learn(docs, ratings.filter(~held_out()))
    got = quality.score(docs, model, keep=["doc_id"]).join(ratings.filter(held_out()), "doc_id")
    n = {(r["quality"], r["selected"]): r["n"] for r in got.groupBy("quality", "selected").agg(F.count("*").alias("n")).collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.9
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.8


def test_three_grades():
    rng = np.random.default_rng(1)
    good, bad = [f"good{i}" for i in range(30)], [f"bad{i}" for i in range(30)]
    texts, y = [], []
    for _ in range(900):
        g = int(rng.integers(0, 3))
        texts.append(" ".join(rng.choice(good if rng.random() < (0.1, 0.5, 0.9)[g] else bad) for _ in range(40)))
        y.append(g)
    model = quality.Ordinal([1, 3, 5]).fit(quality.Features(texts[:600]), np.array(y[:600]))
    assert (np.diff(model.cuts) > 0).all()
    grade, tail = model.predict(quality.Features(texts[600:]))
    assert (np.diff(tail, axis=1) <= 1e-12).all() and (grade >= 1).all() and (grade <= 5).all()
    assert np.mean(np.array([1, 3, 5])[y[600:]] == np.array([1, 3, 5])[np.clip(np.round((grade - 1) / 2), 0, 2).astype(int)]) > 0.85


def test_odd_rows(docs_df):
    docs = docs_df([(i, "fine words here" if i % 2 else "BAD!! BAD!!") for i in range(40)] + [(99, None), (98, "x"), (None, "y")])
    rated = docs_df([(i, i % 2) for i in range(40)] + [(99, 1), (98, None), (None, 1), (500, 0)], "doc_id long, quality int")
    model = quality.learn(docs, rated)
    out = quality.score(docs_df([(1, "fine words", 7), (2, None, 7), (None, "", 7), (1, "fine words", 7), (5, "BAD!!", 7)], "doc_id long, text string, grade int"), model)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "grade", "tail_probability", "selected"] and len(rows) == 5
    assert all(0 <= r["tail_probability"] <= 1 for r in rows)
    by = {r["text"]: r["selected"] for r in rows}
    assert by["fine words"] and not by["BAD!!"]
    none = quality.learn(docs_df([(1, "x")]), docs_df([], "doc_id long, quality int"))
    assert quality.score(docs_df([(1, "x")]), none).count() == 1 and quality.score(docs_df([]), none).count() == 0
