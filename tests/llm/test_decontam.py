"""Operator 5 against plain comparison."""

import random

from marketlake.llm import decontam


def _corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(12)] + ["ÄÖ", "é", "A1"]
    phrase = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, phrase(rng.randint(8, 30))) for i in range(12)] + [(100, "short one"), (101, ""), (102, None), (103, "...")]
    docs = []
    for d in range(60):
        t = phrase(rng.randint(0, 60))
        if d % 3 == 0:
            item = rng.choice(items[:12])[1].split()
            a = rng.randint(0, max(0, len(item) - 10))
            t += " , " + "; ".join(item[a:a + rng.randint(7, 14)]).upper() + " " + phrase(5)
        docs.append((d, t))
    return docs + [(70, None), (71, ""), (72, "a Short-ONE b"), (73, docs[0][1])], items


def _run(docs_df, docs, items, **kw):
    found = decontam.matches(docs_df(docs), docs_df(items, "item_id long, text string"), **kw)
    return found, sorted(tuple(r) for r in decontam.digest(found).collect())


def test_matches_plain_comparison(docs_df, monkeypatch):
    docs, items = _corpus()
    want = sorted(decontam.brute_force(docs, items))
    assert _run(docs_df, docs, items)[1] == want
    assert sum(r[5] for r in want) > 10


def test_spans_and_longest(docs_df):
    found, _ = _run(docs_df, [(1, "x y a b c d e f g h i j k z")], [(7, "q a b c d e f g h i j k")])
    r = found.collect()[0]
    assert [(s.start, s.n_words) for s in r["spans"]] == [(2, 11)]
    assert (r["longest"], r["longest_item"], r["longest_start"]) == (11, "7", 2)


def test_blocks_of_items_merge(docs_df):
    docs, items = _corpus(5)
    want = sorted(decontam.brute_force(docs, items))
    old = decontam.BLOCK_BYTES
    blocks = list(decontam.blocks(docs_df(items, "item_id long, text string"), block_bytes=300))
    assert len(blocks) > 1 and sum(map(len, blocks)) == len(items)
    decontam.blocks.__defaults__ = ("item_id", "text", 300)
    try:
        assert _run(docs_df, docs, items)[1] == want
    finally:
        decontam.blocks.__defaults__ = ("item_id", "text", old)


def test_blocks_give_the_spans_of_one_block(docs_df, monkeypatch):
    """Every column, not only the digest, is the same from one block and from many; adjacent spans are one."""
    docs, items = _corpus(7)
    words = [f"q{i}" for i in range(24)]
    items += [(200, " ".join(words[:12])), (201, " ".join(words[12:])), (202, " ".join(words[6:18]))]
    docs += [(300, "x " + " ".join(words)), (300, "x " + " ".join(words[:12])), (None, " ".join(words[12:]) + " y")]
    run = lambda: decontam.matches(docs_df(docs), docs_df(items, "item_id long, text string"))
    whole = run()
    key = lambda r: str(r)
    want = sorted(whole.collect(), key=key)
    assert [(x.start, x.n_words) for r in want if r["doc_id"] == 300 for x in r["spans"]] in ([(1, 24), (1, 12)], [(1, 12), (1, 24)])
    freed = []
    from pyspark.core.broadcast import Broadcast
    destroy = Broadcast.destroy
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (freed.append(1), destroy(self, *a)))
    monkeypatch.setattr(decontam.blocks, "__defaults__", ("item_id", "text", 400))
    parts = run()
    assert parts.schema.names == whole.schema.names and len(freed) > 2  # each block's copy goes before the next comes
    assert sorted(parts.collect(), key=key) == want


def test_small_arrays_over_long_documents(monkeypatch):
    docs, items = _corpus(9)
    long = [(0, " ".join(t or "" for _, t in docs))]
    monkeypatch.setattr(decontam, "SHARD_WORDS", 37)
    tests = decontam.Tests(items, 10)
    counts, hit, found, best, spans = decontam._probe([long[0][1].encode().translate(decontam.H.LOWER)], tests)
    want = decontam.brute_force(long, items)[0]
    assert (counts[0], hit[0], len({tests.ids[i] for i in found[0]})) == want[1:4]


def test_empty_tables_and_clashing_columns(docs_df):
    assert _run(docs_df, [], [(1, "a b")])[1] == []
    assert [r[5] for r in _run(docs_df, [(1, "a b")], [])[1]] == [False]
    docs = docs_df([(1, "a b", 5, "m"), (2, "zz", None, None)], "doc_id long, text string, n_words int, items string")
    out = decontam.decontaminate(docs, docs_df([(9, "a b")], "item_id long, text string"))
    assert [tuple(r) for r in out.collect()] == [(2, "zz", None, None)] and out.columns == docs.columns
