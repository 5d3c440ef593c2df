"""Operator 6 against plain comparison."""

import random

import numpy as np
import pytest

from marketlake.llm import repeats


def _corpus(seed, n=60):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(30, 160))) for _ in range(5)]
    docs = []
    for d in range(n):
        t = ""
        for _ in range(rng.randint(0, 4)):
            t += "".join(rng.choice("abcdefghijklmnop qrstuvwxyz日") for _ in range(rng.randint(0, 60)))
            if rng.random() < 0.6:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) - 10)
                t += p[a:a + rng.randint(5, 150)]
        docs.append((d, t))
    docs += [(n, "z" * 150), (n + 1, docs[3][1]), (n + 2, None), (n + 3, ""), (n + 4, "xy" * 90 + "q"), (n + 5, "z" * 41)]
    rng.shuffle(docs)
    return docs


def _rows(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("seed,shard_bytes,hot", [(1, 500, 2000), (2, 1 << 20, 2000), (3, 900, 3), (4, 1 << 20, 2)])
def test_matches_plain_comparison(docs_df, monkeypatch, keep_first, seed, shard_bytes, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = _corpus(seed)
    fn = repeats._repeated

    def repeated(rows, hot=hot):
        repeats.HOT = hot  # workers import the module afresh
        return fn(rows)

    monkeypatch.setattr(repeats, "_repeated", repeated)
    got = _rows(repeats.dedup(docs_df(docs).repartition(3), length=40, keep_first=keep_first, shard_bytes=shard_bytes))
    assert got == sorted(repeats.brute_force(docs, 40, keep_first))
    assert sum(r[2] for r in got) > 500


def test_suffix_order_and_previous_factors():
    rng = random.Random(2)
    for length in (8, 13, 40):
        text = "".join(rng.choice("ab") for _ in range(700)).encode()
        starts = np.arange(len(text) - length + 1)
        order, group = repeats.suffix_order(np.frombuffer(text, np.uint8), starts, length)
        strings = [text[i:i + length] for i in order]
        assert strings == sorted(strings)
        assert [a == b for a, b in zip(strings, strings[1:])] == (group[1:] == group[:-1]).tolist()
        later, source = repeats.previous_factors(order, group)
        assert all(text[a:a + length] == text[b:b + length] and b < a for a, b in zip(later, source))
        assert set(later.tolist()) == {i for i in starts.tolist() if text.find(text[i:i + length]) < i}


def test_empty_table_kept_bytes_and_repeated_rows(docs_df):
    assert repeats.dedup(docs_df([])).collect() == []
    rng = random.Random(1)
    p = "".join(rng.choice("abcdefgh") for _ in range(500))
    rows = repeats.dedup(docs_df([(1, "x" + p), (2, p + "é"), (None, "x")])).collect()
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in rows}
    assert kept == {1: "x" + p, 2: "é", None: "x"}
    twice = repeats.dedup(docs_df([(1, p), (1, p), (2, p)]), shard_bytes=1).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in twice) == [(1, 0), (1, 0), (2, 500)]
