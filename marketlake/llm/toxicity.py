"""Operator 8: toxic spans by a linear-chain conditional random field.

Tokens are labelled from document labels: a token of a toxic document is toxic if its word or one
of its prefixes occurs in toxic documents far more often than in clean ones.  A two-state chain over
each sentence learns hashed word and prefix weights and transitions from them by maximum likelihood.
Forward-backward marginals of a document's tokens then give its score and its offending offsets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm import hashing as H
from marketlake.llm.common import arrow_schema, labelled_sample, tune

#: Labelled text that the model is fitted on: at most about this many bytes of each label, whole documents.
TRAIN_BYTES = 4 << 20
#: Entries of the hashed weight table.
BITS = 18
PREFIXES = (3, 4, 5, 6, 7)
#: A token is labelled toxic from this log-odds on, if the feature occurs in this many toxic documents.
LOG_ODDS, SUPPORT = 3.2, 4
#: Words of one chain; a longer sentence goes on as a further chain.
CHAIN = 96
STEPS, RATE, DECAY = 45, 0.3, 3e-4
_BATCH_BYTES = 2 << 20
_SLOTS = np.uint64((1 << BITS) - 1)
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True
#: Letters and digits of any script are word bytes; A-Z are lower-cased before.
_WORDS = H.ALNUM_WORDS


class Tokens:
    """The tokens of many whole texts: hashed features, chains, byte offsets."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8").translate(H.LOWER) for t in texts]
        buf, s, e, self.first = H.split(raw, _WORDS)
        self.n, lens = len(s), e - s
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        begin = np.cumsum([1, *[len(t) + 1 for t in raw]])
        self.start, self.end = s - begin[self.doc], e - begin[self.doc]
        head = np.zeros(self.n, np.uint64)
        for j in range(8):
            b = buf[np.minimum(s + j, len(buf) - 1)].astype(np.uint64)
            head |= np.where(lens > j, b, np.uint64(0)) << np.uint64(8 * (7 - j))
        cols = [H.word_hashes(buf, s, e)]
        for p in PREFIXES:
            x = H.mix((head >> np.uint64(8 * (8 - p))) * np.uint64(31) + np.uint64(p))
            cols.append(np.where(lens >= p, x, 0))
        # slot 0 stands for "no such prefix" and never weighs anything
        self.slots = np.stack([np.where(c == 0, 0, (c & _SLOTS) | np.uint64(1)) for c in cols], 1).astype(np.int32)
        # a chain ends where a sentence or a document does, and after CHAIN words
        ends = np.concatenate([[0], np.cumsum(_ENDS[buf])])
        new = np.zeros(self.n, bool)
        if self.n:
            new[0] = True
            new[1:] = (self.doc[1:] != self.doc[:-1]) | (ends[s[1:]] != ends[e[:-1]])
            run = np.flatnonzero(new)
            within = np.arange(self.n) - np.repeat(run, np.diff(np.append(run, self.n)))
            new |= within % CHAIN == 0
        self.chains = np.flatnonzero(new)


class Crf:
    """Two states per token; ``w`` hashed weights, ``bias`` and transitions ``t`` of state 1 against 0."""

    def __init__(self):
        self.w = np.zeros(1 << BITS, np.float32)
        self.bias, self.t = -4.0, np.zeros((2, 2))
        self.calibration = np.array([0.0, 1.0, 0.0])

    def marginals(self, tok: Tokens, pairs: bool = False):
        """P(state 1) of every token, and the expected transitions if ``pairs``."""
        emit = self.w[tok.slots].sum(1).astype(np.float64) + self.bias if tok.n else np.empty(0)
        lens = np.diff(np.append(tok.chains, tok.n))
        order = np.argsort(-lens, kind="stable")
        at, lens = tok.chains[order], lens[order]
        alive = np.searchsorted(-lens, -np.arange(1, lens.max(initial=0) + 1), "right")  # chains longer than each step
        a1, b1 = np.zeros(tok.n), np.zeros(tok.n)  # log-odds of state 1 against 0, forwards and backwards
        (t00, t01), (t10, t11) = self.t
        for j, k in enumerate(alive):
            i = at[:k] + j
            a1[i] = emit[i] if not j else emit[i] + np.logaddexp(t01, a1[i - 1] + t11) - np.logaddexp(t00, a1[i - 1] + t10)
        for j in range(len(alive) - 2, -1, -1):
            i = at[:alive[j + 1]] + j
            m = b1[i + 1] + emit[i + 1]
            b1[i] = np.logaddexp(t10, t11 + m) - np.logaddexp(t00, t01 + m)
        p = 1 / (1 + np.exp(-np.clip(a1 + b1, -40, 40)))
        if not pairs:
            return p
        inner = np.setdiff1d(np.arange(tok.n), tok.chains, assume_unique=True)
        m = b1[inner] + emit[inner]
        prev = a1[inner - 1]
        z = np.stack([np.full(len(inner), t00), t01 + m, prev + t10, prev + t11 + m], 1)
        z = np.exp(z - z.max(1, keepdims=True))
        return p, (z / z.sum(1, keepdims=True)).sum(0).reshape(2, 2), inner

    def fit(self, tok: Tokens, y: np.ndarray) -> None:
        """Maximum likelihood with Adagrad; gradients are observed less expected counts."""
        seen_w, seen_t, seen_b = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6), 1e-6
        flat, width = tok.slots.ravel(), tok.slots.shape[1]
        for _ in range(STEPS):
            p, expected, inner = self.marginals(tok, True)
            d = y - p
            g = np.bincount(flat, np.repeat(d, width), 1 << BITS) - DECAY * tok.n / 100 * self.w
            g[0] = 0
            observed = np.bincount(2 * y[inner - 1].astype(int) + y[inner].astype(int), minlength=4).reshape(2, 2)
            gt, gb = observed - expected, d.sum()
            seen_w, seen_t, seen_b = seen_w + g * g, seen_t + gt * gt, seen_b + gb * gb
            self.w += (RATE * g / np.sqrt(seen_w)).astype(np.float32)
            self.t += RATE * gt / np.sqrt(seen_t) / 4
            self.bias += RATE * gb / np.sqrt(seen_b) / 4

    def features(self, tok: Tokens, p: np.ndarray, n_docs: int) -> np.ndarray:
        """Per document: log-odds of the likeliest toxic token, and how many are expected."""
        out = np.zeros((n_docs, 2))
        logit = np.log(np.clip(p, 1e-9, 1)) - np.log(np.clip(1 - p, 1e-9, 1))
        out[:, 0] = -12
        np.maximum.at(out[:, 0], tok.doc, logit)
        out[:, 1] = np.log1p(np.bincount(tok.doc, np.where(p > 0.05, p, 0), n_docs))
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Logistic regression from document features to document labels."""
        z = np.column_stack([np.ones(len(x)), x])
        c = np.zeros(3)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(3)
            c += np.clip(np.linalg.solve(h, z.T @ (y - p) - 1e-2 * c), -5, 5)
        self.calibration = c

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.calibration[0] + x @ self.calibration[1:], -40, 40)))


def token_labels(tok: Tokens, toxic: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic documents with a telling word or prefix."""
    bad, good = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for c in range(tok.slots.shape[1]):
        pairs = np.unique(tok.doc.astype(np.int64) << BITS | tok.slots[:, c])
        doc, slot = pairs >> BITS, pairs & int(_SLOTS)
        bad += np.bincount(slot, toxic[doc], 1 << BITS)
        good += np.bincount(slot, 1 - toxic[doc], 1 << BITS)
    odds = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((1 - toxic).sum() + 1))
    telling = (odds >= LOG_ODDS) & (bad >= SUPPORT)
    telling[0] = False
    return (telling[tok.slots].any(1) & (toxic[tok.doc] > 0)).astype(np.float64)


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", train_bytes: int = TRAIN_BYTES, **columns) -> Crf:
    """Fit on a bounded sample of whole labelled documents (``labelled_sample``): up to ``train_bytes`` of each
    label.  Labels other than 0 and 1 teach nothing; without both labels all scores are low."""
    texts, y, _ = labelled_sample(docs, labels.filter(F.col(label_col).isin(0, 1)), label_col, train_bytes, **columns)
    crf, y = Crf(), np.array(y, np.float64)
    if not len(y) or y.min() == y.max():
        crf.calibration = np.array([-3.0, 0.0, 0.0])
        return crf
    # two thirds fit the chain, the rest sets the document score: words that only fitted texts have don't inflate it
    fit, rest = np.arange(len(y)) % 3 != 2, np.arange(len(y)) % 3 == 2
    if len(np.unique(y[fit])) < 2 or len(np.unique(y[rest])) < 2:
        fit = rest = np.ones(len(y), bool)
    tok = Tokens([t for t, use in zip(texts, fit) if use])
    crf.fit(tok, token_labels(tok, y[fit]))
    tok = Tokens([t for t, use in zip(texts, rest) if use])
    crf.calibrate(crf.features(tok, crf.marginals(tok), int(rest.sum())), y[rest])
    return crf


def score(docs: DataFrame, crf: Crf, text_col: str = "text", keep: list[str] | None = None, threshold: float = 0.7, spans: bool = True) -> DataFrame:
    """``docs`` with score (0 to 1), predicted (1 from ``threshold`` on) and the character offsets of toxic tokens.

    Null, empty and wordless texts get the score of no toxic token.  Repeated rows repeat their result."""
    tune(docs.sparkSession)
    box = docs.sparkSession.sparkContext.broadcast(crf)  # 2**BITS weights
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), *([T.StructField("spans", span)] if spans else [])]
    names = {f.name for f in fields}
    keep = [c for c in (keep or docs.columns) if c not in names]
    sent = list(dict.fromkeys([*keep, text_col]))
    at, n_keep = sent.index(text_col), len(keep)
    out = T.StructType([*[docs.schema[c] for c in keep], *fields])
    types = arrow_schema(T.StructType(fields)).types

    def run(batches):
        model = box.value
        for b in batches:
            texts = b.column(at).to_pylist()
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size < _BATCH_BYTES):
                    size += len(texts[j] or "")
                    j += 1
                tok = Tokens(texts[i:j])
                p = model.marginals(tok)
                s = model.score(model.features(tok, p, j - i))
                cols = [s, (s >= threshold).astype(np.int32)]
                if spans:
                    found = [[] for _ in range(j - i)]
                    for k in np.flatnonzero(p >= 0.5):
                        d = tok.doc[k]
                        raw = texts[i + d].encode("utf-8")
                        found[d].append({"start": len(raw[:tok.start[k]].decode("utf-8")), "end": len(raw[:tok.end[k]].decode("utf-8"))})
                    cols.append(found)
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, j - i) for c in range(n_keep)], *[pa.array(c, t) for c, t in zip(cols, types)]], [f.name for f in out])
                i = j

    return docs.select(*sent).mapInArrow(run, out)
