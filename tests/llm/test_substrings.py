"""Operator 4 against plain comparison."""

import random

import pytest

from marketlake.llm import substrings


def _corpus(seed, n=80):
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c d e f gg hh ii é 日本 x-y".split())
    passages = [" ".join(word() for _ in range(rng.randint(15, 70))) for _ in range(5)]
    docs = []
    for d in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(" ".join(word() + str(rng.randint(0, 99)) for _ in range(rng.randint(0, 25))))
            if rng.random() < 0.6:
                p = rng.choice(passages).split()
                a = rng.randint(0, len(p) - 5)
                parts.append("\t ".join(p[a:a + rng.randint(5, 60)]))
        docs.append((d, "\n".join(parts)))
    docs += [(n, "z " * 100), (n + 1, docs[3][1]), (n + 2, docs[3][1]), (n + 3, None), (n + 4, ""), (n + 5, "\x85 y\x1c " * 30)]
    rng.shuffle(docs)
    return docs


def _digest(df):
    return sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


@pytest.mark.parametrize("seed,shard_bytes", [(1, 500), (2, 1 << 20), (3, 3000)])
def test_matches_plain_comparison(docs_df, seed, shard_bytes):
    docs = _corpus(seed)
    df = docs_df(docs).repartition(3)
    got = _digest(substrings.dedup(df, shard_bytes=shard_bytes))
    assert got == sorted(substrings.brute_force(docs))
    assert sum(r[2] for r in got) > 300


def test_other_windows(docs_df):
    docs = _corpus(4, 40)
    for window in (5, 8):
        assert _digest(substrings.dedup(docs_df(docs), window=window, shard_bytes=900)) == sorted(substrings.brute_force(docs, window))


def test_kept_text_and_spans(docs_df):
    p = " ".join(f"w{i}" for i in range(25))
    rows = {r["doc_id"]: r for r in substrings.dedup(docs_df([(1, "a " + p), (2, "b  " + p + "\nc"), (None, p)])).collect()}
    assert rows[1]["kept"] == "a " + p and rows[2]["kept"] == "b c" and rows[None]["kept"] == ""
    assert [tuple(s) for s in rows[2]["spans"]] == [(1, 25)]


def test_empty_table_and_repeated_rows(docs_df):
    assert substrings.dedup(docs_df([])).collect() == []
    p = " ".join(f"w{i}" for i in range(25))
    twice = substrings.dedup(docs_df([(1, p), (1, p), (2, p)]), shard_bytes=1)
    assert sorted((r["doc_id"], r["n_removed"]) for r in twice.collect()) == [(1, 0), (1, 0), (2, 25)]
