"""Operator 3 against comparing all pairs."""

import numpy as np
import pytest

from marketlake.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def _rows(seed, n=400, d=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, d))
    rows = []
    for i in range(n):
        v = centres[rng.integers(0, 40)] + rng.choice([0.0, 0.05, 0.12]) * rng.normal(size=d)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 2))))
    rows += [(n + i, rows[0][1], rows[0][2]) for i in range(30)]  # copies
    rows += [(n + 40 + i, [x * 2 for x in rows[5][1]], rows[5][2]) for i in range(3)]
    odd = [None, [], [0.0] * d, [None] + [1.0] * (d - 1), [float("nan")] + [1.0] * (d - 1), [float("inf")] * d, [1.0, 2.0]]
    rows += [(n + 60 + i, v, 1) for i, v in enumerate(odd)] + [(n + 80, rows[0][1], None), (n + 81, [-x for x in rows[0][1]], rows[0][2])]
    return rows


@pytest.mark.parametrize("block", [1024, 5])
def test_matches_all_pairs(docs_df, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = _rows(1)
    got = sorted(tuple(r) for r in embeddings.near_duplicates(docs_df(rows, SCHEMA).repartition(3)).collect())
    assert got == embeddings.brute_force(rows, 0.98)
    assert sum(r[1] for r in got) > 500


def test_hadamard_keeps_lengths_and_angles():
    x = np.random.default_rng(2).normal(size=(5, 32))
    y = embeddings.hadamard(x)
    assert np.allclose(y @ y.T, x @ x.T) and np.allclose(embeddings.hadamard(y), x)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 2000, 64))
    a, b = embeddings.unit(a), embeddings.unit(b - (embeddings.unit(a) * b).sum(1, keepdims=True) * embeddings.unit(a))
    x, y = embeddings.buckets(a), embeddings.buckets(embeddings.unit(0.98 * a + np.sqrt(1 - 0.98 ** 2) * b))
    assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(x, y)]) > 0.995


def test_empty_table_null_ids_and_clashing_columns(docs_df):
    assert embeddings.near_duplicates(docs_df([], SCHEMA)).collect() == []
    df = docs_df([(2, [1.0, 0.0], 1, 5), (1, [1.0, 0.0], 1, 6), (None, [1.0, 0.0], 1, 7)], "vec_id long, embedding array<double>, label int, n_links int")
    assert {tuple(r) for r in embeddings.near_duplicates(df).collect()} == {(2, 1, 1, False), (1, 1, 1, True), (None, 0, None, True)}


@pytest.mark.parametrize("turn", [1, -1])
def test_one_id_with_two_vectors(docs_df, turn):
    rows = [(3, [1.0, 0.0, 0.0, 0.0], 1), (3, [0.0, 1.0, 0.0, 0.0], 1), (5, [1.0, 0.05, 0.0, 0.0], 1), (6, [0.0, 1.0, 0.05, 0.0], 1), (3, [1.0, 0.01, 0.0, 0.0], 1), (2, [0.0, 1.0, 0.0, 0.1], 2)]
    got = sorted(tuple(r) for r in embeddings.near_duplicates(docs_df(rows[::turn], SCHEMA)).collect())
    assert got == embeddings.brute_force(rows, 0.98) and got[1:4] == [(3, 1, 3, True), (3, 2, 3, True), (3, 2, 3, True)]


@pytest.mark.parametrize("d,n", [(2, 1000), (16, 10**5), (64, 10**6)])
def test_plans_keep_their_recall(d, n):
    tables, hashes = embeddings.plan(d, n, 0.98)
    rng = np.random.default_rng(d)  # other pairs than those of the plan
    a, b = rng.normal(size=(2, 1500, d))
    a = embeddings.unit(a)
    b = embeddings.unit(0.98 * a + np.sqrt(1 - 0.98 ** 2) * embeddings.unit(b - (a * b).sum(1, keepdims=True) * a))
    x, y = (embeddings.buckets(v, tables=tables, hashes=hashes) for v in (a, b))
    assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(x, y)]) > 0.99


def test_chains_of_links():
    rng = np.random.default_rng(6)
    order = rng.permutation(500)
    low = embeddings.smallest_linked(600, order[:-1], order[1:])
    assert (low[:500] == 0).all() and (low[500:] == np.arange(500, 600)).all()
