"""Operator 1 against comparing all pairs."""

import random

import numpy as np
import pytest

from marketlake.llm import minhash
from marketlake.llm.components import components


def _corpus(seed, n=150, big=60):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 60))
    docs, t = [], 0
    bases = [[word() for _ in range(rng.choice([1, 2, 3, 8, 40, 200, 400]))] for _ in range(25)]
    for d in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9]) if len(w) > 20 else 0):
            w[rng.randrange(len(w))] = word()
        docs.append((d, rng.choice([" ", "\n", "  "]).join(x.upper() if rng.random() < 0.1 else x for x in w)))
    w = [word() for _ in range(150)]  # one group whose members differ near the threshold
    for d in range(n, n + big):
        v = list(w)
        for _ in range(rng.randint(0, 7)):
            v[rng.randrange(len(v))] = word()
        docs.append((d, " ".join(v)))
    docs += [(n + big, None), (n + big + 1, ""), (n + big + 2, "  \n"), (n + big + 3, ""), (n + big + 4, "a1 b2"), (n + big + 5, "A1 b2")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed,words,percent", [(1, 3, 85), (2, 5, 80)])
def test_matches_all_pairs(docs_df, seed, words, percent):
    docs = _corpus(seed)
    got = sorted(tuple(r) for r in minhash.near_duplicates(docs_df(docs).repartition(4), words=words, percent=percent).collect())
    assert got == minhash.brute_force(docs, words, percent)
    assert len({r[2] for r in got}) < len(got) - 60


def test_blocks_of_a_large_bucket(docs_df, monkeypatch):
    monkeypatch.setattr(minhash, "OUTSIDE", 3)
    monkeypatch.setattr(minhash, "MEMBERS", 7)
    docs = _corpus(5, 20, 60)
    got = sorted(tuple(r) for r in minhash.near_duplicates(docs_df(docs), words=3, percent=85).collect())
    assert got == minhash.brute_force(docs, 3, 85)


def test_estimates():
    rng = np.random.default_rng(1)
    for n, j in ((2000, 0.85), (2000, 0.5), (60, 0.8), (5000, 0.0)):
        errors = []
        for _ in range(40):
            x = rng.integers(0, 2**63, 3 * n, dtype=np.uint64)
            both = int(2 * n * j / (1 + j))
            a, b = minhash.H.mix(x[:n]), minhash.H.mix(np.concatenate([x[:both], x[n:2 * n - both]]))
            r = minhash.registers([np.unique(a), np.unique(b)])
            errors.append(minhash.estimate(r[0], r[1], np.float64(n), np.float64(n))[0] - j)
        assert abs(np.mean(errors)) < 0.03


def test_nulls_repeated_rows_empty_table_and_extra_columns(docs_df):
    assert minhash.near_duplicates(docs_df([])).collect() == []
    t = " ".join(map(str, range(30)))
    docs = docs_df([(5, t, 1, 2), (3, t, None, 3), (3, t, 1, 1), (None, t, 1, 1), (9, None, 1, 1), (8, "x y", 1, 1)],
                   "doc_id long, text string, component_id int, n int")
    rows = sorted(((r[0], r[2], r[3]) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(5, 3, False), (3, 3, True), (3, 3, True), (None, 3, False), (9, 9, True), (8, 8, True)], key=str)
    out = minhash.keep_first(docs)
    assert out.columns == docs.columns and sorted(r[0] for r in out.collect()) == [3, 8, 9]  # one row of each group


def test_copies_without_an_id_join_their_group(docs_df):
    t, u = " ".join(map(str, range(30))), " ".join(map(str, range(50, 90)))
    docs = docs_df([(None, t, "a"), (None, t, "b"), (None, t.upper() + " 30", "c"), (None, u, "d"), (None, "", "e"), (None, None, "f"), (4, u, "g")], "doc_id long, text string, x string")
    got = [(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()]
    ends = [(None, 4, False), (4, 4, True), (None, None, True), (None, None, True)]  # d, g, e, f
    three = sorted(got, key=str)
    for r in ends:
        three.remove(r)
    assert {r[:2] for r in three} == {(None, None)} and 1 <= sum(r[2] for r in three) <= 2  # a and b are one text
    kept = minhash.keep_first(docs).collect()
    assert sorted(r.x for r in kept if r.x in "defg") == ["e", "f", "g"] and len([r for r in kept if r.x in "abc"]) == 1


@pytest.mark.parametrize("turn", [1, -1])
def test_one_id_with_two_texts(docs_df, turn):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "pq")
    rows = [(3, a), (3, b), (5, a + " tail"), (6, b + " tail"), (7, "x " + b)]
    got = minhash.near_duplicates(docs_df(rows[::turn]), words=3, percent=85)
    assert sorted(tuple(r) for r in got.collect()) == minhash.brute_force(rows, 3, 85)
    assert sorted(r.doc_id for r in minhash.keep_first(docs_df(rows[::turn]), words=3, percent=85).collect()) == [3, 3]


def test_components_of_a_long_path(docs_df):
    links = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000) for i in range(50)] + [(2000, 2001), (2001, 2000), (7, 7)]
    got = dict(tuple(r) for r in components(docs_df(links, "a long, b long")).collect())
    want = {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 50)} | {2001: 2000}
    assert got == want
