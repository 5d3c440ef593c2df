"""Operator 7: document quality by ordinal cumulative-link regression.

P(grade <= k) = sigmoid(threshold_k - weight . x), with one weight vector over hashed words, word shapes
and whole-document marks, shared by all grades, and increasing thresholds.  The expected grade and
the chance of a grade or better follow for every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlake.llm import hashing as H
from marketlake.llm.common import arrow_schema, labelled_sample, tune

#: Rated text that the model is fitted on: at most about this many bytes of each grade, whole documents.
TRAIN_BYTES = 3 << 20
BITS = 18
STEPS, RATE, DECAY = 80, 0.5, 1e-5
_BATCH_BYTES = 2 << 20
_SLOTS = np.uint64((1 << BITS) - 1)
_SHAPE = bytes(0x41 if 0x41 <= b <= 0x5A else 0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256))


class Features:
    """Hashed features of many whole texts: ``slot`` and ``weight`` of document ``doc``; a document's sum to 3."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8") for t in texts]
        buf, s, e, first = H.split(raw, H.SPACE_WORDS)
        lens = np.diff(first)
        doc = np.repeat(np.arange(len(texts)), lens)
        low = np.frombuffer(buf.tobytes().translate(H.LOWER), np.uint8)
        shape = np.frombuffer(buf.tobytes().translate(_SHAPE), np.uint8)
        word = H.word_hashes(low, s, e)
        tail = H.word_hashes(shape, np.maximum(s, e - 3), e)
        head = H.word_hashes(shape, s, np.minimum(e, s + 2))
        marks = H.mix(tail * np.uint64(31) + head)
        # whole-document marks: share of different words, length of text and of words, in steps
        different = np.bincount(_distinct(doc, word), minlength=len(texts))
        n = np.maximum(lens, 1)
        size = np.array([len(r) for r in raw])
        steps = [np.floor(12 * different / n), np.floor(np.log2(n)), np.floor(2 * np.log2(1 + size / n))]
        whole = [H.mix(x.astype(np.uint64) * np.uint64(97) + np.uint64(k + 1)) for k, x in enumerate(steps)]
        every = np.arange(len(texts))
        self.doc = np.concatenate([doc, doc, every, every, every])
        self.slot = (np.concatenate([word, marks, *whole]) & _SLOTS).astype(np.int32)
        share = 1 / n[doc]
        self.weight = np.concatenate([share, share, *[np.full(len(texts), 1 / 3)] * 3])
        self.n = len(texts)


def _distinct(doc: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The document of each different (document, word)."""
    order = np.lexsort((word, doc))
    d, w = doc[order], word[order]
    return d[np.append(True, (d[1:] != d[:-1]) | (w[1:] != w[:-1]))[:len(d)]]


class Ordinal:
    def __init__(self, grades: list[int]):
        self.grades = np.array(sorted(grades))
        k = max(0, len(self.grades) - 1)
        self.w, self.cuts = np.zeros(1 << BITS), np.arange(k, dtype=np.float64) - (k - 1) / 2

    def latent(self, x: Features) -> np.ndarray:
        return np.bincount(x.doc, self.w[x.slot] * x.weight, x.n)

    def below(self, z: np.ndarray) -> np.ndarray:
        """P(grade <= k) for every grade but the last."""
        return 1 / (1 + np.exp(-np.clip(self.cuts[None, :] - z[:, None], -40, 40)))

    def fit(self, x: Features, y: np.ndarray) -> "Ordinal":
        """Maximum likelihood with Adagrad; thresholds are kept increasing through their gaps."""
        if not len(self.cuts):
            return self
        seen, first, gaps = np.full(1 << BITS, 1e-8), self.cuts[0], np.log(np.diff(self.cuts) + 1e-9)
        seen_c, rows = np.full(len(self.cuts), 1e-8), np.arange(len(y))
        for _ in range(STEPS):
            self.cuts = np.concatenate([[first], first + np.cumsum(np.exp(gaps))])
            f = np.concatenate([np.zeros((len(y), 1)), self.below(self.latent(x)), np.ones((len(y), 1))], 1)
            d = f * (1 - f)  # derivatives by threshold
            p = np.maximum(f[rows, y + 1] - f[rows, y], 1e-9)
            gz = -(d[rows, y + 1] - d[rows, y]) / p  # of the log-likelihood by the latent value
            gc = np.zeros((len(y), f.shape[1]))
            gc[rows, y + 1] += d[rows, y + 1] / p
            gc[rows, y] -= d[rows, y] / p
            gc = gc[:, 1:-1].sum(0)
            g = np.bincount(x.slot, gz[x.doc] * x.weight, 1 << BITS) - DECAY * len(y) * self.w
            seen += g * g
            self.w += RATE * g / np.sqrt(seen)
            by_gap = np.concatenate([[gc.sum()], np.cumsum(gc[::-1])[::-1][1:] * np.exp(gaps)])
            seen_c += by_gap * by_gap
            step = RATE / 4 * by_gap / np.sqrt(seen_c)
            first, gaps = first + step[0], gaps + step[1:]
        self.cuts = np.concatenate([[first], first + np.cumsum(np.exp(gaps))])
        return self

    def predict(self, x: Features) -> tuple[np.ndarray, np.ndarray]:
        """(expected grade, P(grade >= g) for every grade g)."""
        below = self.below(self.latent(x))
        tail = np.concatenate([np.ones((x.n, 1)), 1 - below], 1)
        p = tail - np.concatenate([tail[:, 1:], np.zeros((x.n, 1))], 1)
        return p @ self.grades, tail


def learn(docs: DataFrame, ratings: DataFrame, grade_col: str = "quality", train_bytes: int = TRAIN_BYTES, **columns) -> Ordinal:
    """Fit on a bounded sample of whole rated documents (``labelled_sample``): up to ``train_bytes`` of each
    grade, less when grades are many.  Rows without a grade teach nothing."""
    texts, y, grades = labelled_sample(docs, ratings, grade_col, train_bytes, **columns)
    model = Ordinal(grades or [0])
    return model.fit(Features(texts), np.searchsorted(model.grades, y)) if texts else model


def score(docs: DataFrame, model: Ordinal, text_col: str = "text", keep: list[str] | None = None, at_least: int | None = None, chance: float = 0.5) -> DataFrame:
    """``docs`` with grade (expected), tail_probability (of ``at_least``, by default the top grade) and
    selected (that reaches ``chance``).  Null and empty texts are scored as texts without words."""
    tune(docs.sparkSession)
    box = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights
    at_least = int(model.grades[-1]) if at_least is None else at_least
    level = int(np.searchsorted(model.grades, at_least))
    fields = [T.StructField("grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType()), T.StructField("selected", T.BooleanType())]
    keep = [c for c in (keep or docs.columns) if c not in {f.name for f in fields}]
    sent = list(dict.fromkeys([*keep, text_col]))
    at, n_keep = sent.index(text_col), len(keep)
    out = T.StructType([*[docs.schema[c] for c in keep], *fields])
    types = arrow_schema(T.StructType(fields)).types

    def run(batches):
        m = box.value
        for b in batches:
            texts = b.column(at).to_pylist()
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size < _BATCH_BYTES):
                    size += len(texts[j] or "")
                    j += 1
                grade, tail = m.predict(Features(texts[i:j]))
                p = tail[:, level] if level < tail.shape[1] else np.zeros(j - i)
                cols = [grade, p, p >= chance]
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, j - i) for c in range(n_keep)], *[pa.array(c, t) for c, t in zip(cols, types)]], [f.name for f in out])
                i = j

    return docs.select(*sent).mapInArrow(run, out)
