"""Operator 13 against applying the filters one by one, in every order."""

import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest

from marketlake.llm import audit

DOCS = "doc_id long, text string, source string, mask int, h string, t string, part string"
LABELS = "doc_id long, quality int, toxic int, part string"


def brute_force(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))

    def fails(i, t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        got = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        return {x for x, bad in got.items() if bad}

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for i, t, s in docs:
        parts[s or ""].append((i, fails(i, t)))
    out, shapley = {}, defaultdict(int)
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            left, gone = rows, []
            for step, x in enumerate(order, 1):
                now = [r for r in left if x in r[1]]
                rest = [r for r in left if x not in r[1]]
                out[part, "".join(order), step] = [len(rest), len(now), sum(x in r[1] for r in gone), sum(r[1] == {x} for r in rows),
                                                   sum(r[0] in good for r in now), sum(r[0] in toxic for r in now)]
                shapley[part, x] += len(now)
                left, gone = rest, gone + now
    return sorted((p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items())


def _rows(seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, v)) for _ in range(n))
            for n, v in ((150, 900), (200, 900), (260, 900), (260, 9), (200, 100))]
    for i in range(160):
        t = rng.choice(base) + rng.choice(["", "", "", " $5", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3, f" {i}", " "])
        docs.append((i, t, rng.choice(["web", "web", "web", "book", "", None])))
        if rng.random() < 0.5:
            labels.append((i, rng.choice([0, 1, None]), rng.choice([0, 0, 1])))
    docs += [(None, base[0], "web"), (None, "unique text", None), (7, docs[7][1], docs[7][2]), (7, "another text of one id", "book"), (500, None, "web"), (501, "", "web"), (502, "\n \t\x1f é🙂", "odd")]
    labels += [(3, 1, 1), (3, 0, 0), (None, 1, 1), (9999, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("sketch_bytes", [audit.SKETCH_BYTES, 40])
def test_matches_step_by_step(docs_df, sketch_bytes):
    docs, labels = _rows()
    frame = docs_df([(i, t, s, 1, "x", "y", "z") for i, t, s in docs], DOCS).repartition(5)
    got = audit.audit(frame, docs_df([(*r, "p") for r in labels], LABELS), sketch_bytes=sketch_bytes, cell_count=256)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(docs, labels)


def test_no_rows(docs_df):
    assert audit.audit(docs_df([], DOCS), docs_df([], LABELS)).collect() == []
    assert audit.audit(docs_df([(1, None, None, 1, "", "", "")], DOCS), docs_df([], LABELS)).count() == 600


def test_sketch_clears_unique_texts_only(spark, docs_df):
    rng = np.random.default_rng(4)
    h = rng.integers(-2**63, 2**63 - 1, 20_000)
    rows = [(int(x),) for x in h] + [(int(x),) for x in h[:500]]
    blocks = 1
    bits = spark.sparkContext.broadcast(audit.sketch(docs_df(rows, "h long").repartition(7), blocks))
    frame = docs_df([(int(x), i < 500) for i, x in enumerate(h)], "h long, twice boolean")
    got = frame.withColumn("maybe", audit.maybe_repeated(bits, blocks)("h"))
    assert got.filter("twice AND NOT maybe").count() == 0 and got.filter("maybe AND NOT twice").count() < 0.05 * len(h)
