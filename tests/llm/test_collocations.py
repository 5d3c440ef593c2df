"""Operator 12 against counting every n-gram."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketlake.llm import collocations as C
from marketlake.llm.automata import Arcs


def brute_force(rows, longest=5, least=100, top=2000):
    f, n, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(0x41, 0x5B)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    for lang, c in f.items():
        found = []
        good = {g for g, a in c.items() if len(g) > 1 and a >= least}
        for g in good:
            if any(len(h) > len(g) and c[h] >= c[g] and any(h[i:i + len(g)] == g for i in range(len(h))) for h in good):
                continue
            score, k = min((1000 * c[g] * n[lang] // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -c[g], " ".join(g), c[g[:k]], c[g[k:]]))
        out += [(lang, i, p, -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def _rows(seed=1, n=150):
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in", "is", "é", "a.b"]
    set_phrases = [["new", "york", "city"], ["in", "order", "to"], ["q", "r", "s", "t", "u", "v"], ["the", "the", "the", "the"]]
    rows = []
    for _ in range(n):
        w = []
        for _ in range(rng.choice([0, 1, 5, 40, 120])):
            w += rng.choice(set_phrases) if rng.random() < 0.3 else [rng.choice(common + [f"x{rng.randint(0, 40)}"])]
            if rng.random() < 0.1:
                w.append(rng.choice([".", ",", "!", "\n", "\r", "\x0b"]))
        text = "".join(x if x in ".,!\n\r\x0b" else x + rng.choice([" ", " ", "\t", "  "]) for x in w)
        rows.append((text.upper() if rng.random() < 0.1 else text, rng.choice(["en", "en", "en", "fr", None, "und"])))
    return rows + [("hot phrase here " * 40, "en")] * 30 + [(None, "en"), ("", None), (" \t\n", "de"), ("\x00 \x1f é🙂", "de")]


@pytest.mark.parametrize("least,top,shard_bytes,part_entries", [(12, 2000, 4 << 20, 2_000_000), (5, 7, 500, 40)])
def test_matches_every_ngram(docs_df, least, top, shard_bytes, part_entries):
    rows = _rows(least)
    frame = docs_df([(1, t, x, "p", "w") for t, x in rows], "doc_id long, text string, lang string, phrase string, words string").repartition(4)
    got = C.collocations(frame, least=least, top=top, shard_bytes=shard_bytes, part_entries=part_entries)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows, least=least, top=top)


def test_no_phrases(docs_df):
    schema = "text string, lang string"
    assert C.collocations(docs_df([], schema)).collect() == []
    assert C.collocations(docs_df([(None, None), ("a b c", "en")], schema)).collect() == []


def test_union_sums_weights_and_keeps_places():
    rng = np.random.default_rng(2)
    seqs = [rng.integers(0, 6, (2, k)) for k in (0, 50, 1, 90)]
    parts, at = zip(*[Arcs.extend(s, t) for s, t in seqs])
    total, places = Arcs.union(list(parts))
    want = Counter((int(a), int(b)) for s, t in seqs for a, b in zip(s, t))
    assert dict(zip(zip(total.state.tolist(), total.label.tolist()), total.weight.tolist())) == want
    assert list(zip(total.state.tolist(), total.label.tolist())) == sorted(want)
    for (s, t), own, up in zip(seqs, at, places):
        assert (total.state[up[own]] == s).all() and (total.label[up[own]] == t).all()
    number = total.numbered(5, 100)
    assert (number[total.weight >= 5] == 100 + np.arange((total.weight >= 5).sum())).all() and (number[total.weight < 5] == -1).all()
