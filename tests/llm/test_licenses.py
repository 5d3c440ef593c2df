"""Operator 11 against counting out every block and every place."""

import random

import pytest

from marketlake.llm import licenses as L

ODD = [(900, None), (901, ""), (902, "MIT"), (903, "x MIT license"), (904, "mit\x00license; MIT-License mitlicense"), (None, "the Apache License"), (905, "é mit license🙂 mit license")]


def brute_force(text):
    w = L.words_of(text or "")
    places, base, labels, best, met = set(), set(), set(), 0.0, []
    for i, t in enumerate(L.templates()):
        own, half = set(t.words), t.size // 2
        for b in range(0, max(1, -(-len(w) // half))):
            block = w[b * half:b * half + t.size]
            c = len(own & set(block))
            if c >= t.need:
                met.append((i, b * half, len(block), c / len(own)))
                if not t.phrase:
                    labels.add(t.label)
                    best = max(best, c / len(own))
        if t.phrase:
            at = [p for p in range(len(w)) if tuple(w[p:p + len(t.words)]) == t.words]
            if at:
                places |= {(p, i) for p in at}
                base.add(t.label)
                best = 1.0
    at = [p for p, _ in places]
    return met, (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels | base)), best)


def _docs(seed=3):
    rng = random.Random(seed)
    filler = [f"w{i}" for i in range(300)] + ["the", "of", "license", "public", "mit", "under", "licensed", "general", "by", "nc"]
    rows = []
    for i in range(120):
        w = [rng.choice(filler) for _ in range(rng.choice([0, 3, 30, 300, 900]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            notice = rng.choice(L.templates()).words
            notice = [x for x in notice if rng.random() > 0.04]
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() if rng.random() < 0.2 else x for x in notice]
        rows.append((i, rng.choice([" ", "\n", ", "]).join(w)))
    return rows + [(i, f"Text {i}. Released under the MIT License.") for i in range(200, 260)]  # a third are alike


def test_documents_match_brute_force(docs_df):
    rows = _docs() + ODD + [(3, "Apache license"), (3, "Apache license")]
    frame = docs_df([(*r, "x", 1) for r in rows], "doc_id long, text string, labels string, n_words int").repartition(4)
    got = L.scan(frame).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((i, *brute_force(t)[1]) for i, t in rows), key=repr)
    assert sum(r["n_base"] for r in got) > 60 and len({r["labels"] for r in got}) > 10


def test_blocks_match_brute_force(docs_df):
    rows = _docs(5) + ODD
    got = L.find_blocks(docs_df(rows).repartition(3)).select("doc_id", "template", "first_word", "n_words", "containment").collect()
    want = [(i, *m) for i, t in rows for m in brute_force(t)[0]]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr) and len(want) > 100


def test_empty_table_and_long_text(docs_df):
    assert L.scan(docs_df([])).collect() == []
    text = "word " * 300_000 + "general public license" + " word" * 1000
    r = L.scan(docs_df([(1, text)])).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (301_003, 1, 300_000, 300_000, "gpl", "gpl", 1.0)


def test_templates_are_bounded():
    with pytest.raises(ValueError):
        L.templates([("x", "word " * 2_000_000)])
    with pytest.raises(ValueError):
        L.templates([("x", " .,")])
