"""Operator 11: license notices by an exact set-similarity join of text blocks with templates.

A text is covered by blocks: runs of ``size`` words at every half of ``size``, where ``size`` is the smallest
power of two that is at least twice a template's length, so that every copy of the template lies within a block.
A block meets a template when it holds ``percent`` of the template's distinct tokens.  Tokens are ordered by
their count over all texts, rarest first, and three filters leave few pairs to count out:

* prefix: with ``need`` tokens in common, the ``tokens - need + 1`` rarest of both sides share one;
* length: a block with fewer than ``need`` of the vocabulary's tokens can't meet the template;
* position: from a shared prefix token on, both sides must still hold enough tokens to reach ``need``.

The templates are a bounded parameter, the texts stay where they are: two passes, no shuffle of texts.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import hashing as H
from marketlake.llm.common import ARROW_ROWS, tune

#: Bytes of all templates together; they go to every task.
TEMPLATE_BYTES = 4 << 20
#: Share of a template's distinct tokens that a block must hold; short notices need all.
PERCENT = 90

#: Phrases whose places count, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public notices and passages of common licenses, by label.
NOTICES = [
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
               "without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "released under the bsd license"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial"),
    ("cc-by-nd", "licensed under cc by nd"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
            "the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
            "copyright notice and this permission notice appear in all copies"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the "
            "software without restriction"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


class Template(NamedTuple):
    """One template: its words in order, the tokens a block must share, and whether it is a phrase whose places count."""
    label: str
    words: tuple[str, ...]
    need: int
    size: int
    phrase: bool


def words_of(text: str) -> list[str]:
    """Words of one text, A-Z lower-cased, as the operator takes them."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(0x41, 0x5B)}))


def templates(notices: list[tuple[str, str]] = NOTICES, phrases: dict[str, str] = PHRASES, percent: int = PERCENT) -> list[Template]:
    """Notices at ``percent`` and phrases in full, checked against ``TEMPLATE_BYTES``."""
    out = []
    for label, text, phrase in [*((label, t, False) for label, t in notices), *((label, p, True) for p, label in phrases.items())]:
        words = tuple(words_of(text))
        if not words:
            raise ValueError(f"a template of {label} has no words")
        n = len(set(words))
        out.append(Template(label, words, n if phrase else -(-n * percent // 100), max(8, 1 << (2 * len(words) - 1).bit_length()), phrase))
    if sum(len(w) for t in out for w in t.words) > TEMPLATE_BYTES:
        raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes: join them in several runs")
    return out


def _token_hashes(tokens: list[str]) -> np.ndarray:
    buf, s, e, _ = H.split([t.encode("utf-8") for t in tokens], H.ALNUM_WORDS)
    return H.word_hashes(buf, s, e)


def frequencies(docs: DataFrame, found: list[Template], text_col: str = "text") -> dict[str, int]:
    """How often every token of the templates stands in all texts; the result has a row per token at most."""
    tokens = sorted({w for t in found for w in t.words})
    known = _token_hashes(tokens)
    order = np.argsort(known)
    ranked = known[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), np.int64)
        for b in batches:
            buf, s, e, _ = H.split([(t or "").encode("utf-8").translate(H.LOWER) for t in b.column(0).to_pylist()], H.ALNUM_WORDS)
            h = H.word_hashes(buf, s, e)
            at = np.minimum(np.searchsorted(ranked, h), len(tokens) - 1)
            total += np.bincount(order[at[ranked[at] == h]], minlength=len(tokens))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["token", "n"])

    counted = docs.select(text_col).mapInArrow(run, "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))
    n = {r["token"]: r["n"] for r in counted.collect()}  # a row a token
    return {t: n.get(i, 0) for i, t in enumerate(tokens)}


class Joiner:
    """The templates in global frequency order, and the join of one batch of texts with them."""

    def __init__(self, found: list[Template], counts: dict[str, int]):
        self.templates = found
        order = sorted(counts, key=lambda t: (counts[t], t))
        rank = {t: i for i, t in enumerate(order)}
        hashes = _token_hashes(order)
        self.by_hash = np.argsort(hashes)
        self.hashes = hashes[self.by_hash]
        self.words = [np.array([rank[w] for w in t.words]) for t in found]
        self.sets = [np.unique(w) for w in self.words]
        self.member = np.zeros((len(found), len(order)), bool)
        for row, s in zip(self.member, self.sets):
            row[s] = True
        self.classes = []
        for size in sorted({t.size for t in found}):
            mine = [i for i, t in enumerate(found) if t.size == size]
            prefix: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for i in mine:
                for place, r in enumerate(self.sets[i][:len(self.sets[i]) - found[i].need + 1].tolist()):
                    prefix[r].append((i, place))
            starts = np.zeros(len(order), bool)
            starts[list(prefix)] = True
            self.classes.append((size, self.member[mine].any(0), starts, dict(prefix)))

    def ranks(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(rank of every word or -1, first word of each text and the end)."""
        buf, s, e, first = H.split(texts, H.ALNUM_WORDS)
        h = H.word_hashes(buf, s, e)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.by_hash[at], -1), first

    def blocks(self, rank: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(text, template, first word, end, containment) of every block that meets a template."""
        hit = np.flatnonzero(rank >= 0)
        doc = np.searchsorted(first, hit, "right") - 1
        for size, vocabulary, starts, prefix in self.classes:
            mine = vocabulary[rank[hit]]
            p, d = hit[mine], doc[mine]
            r, half = rank[p], size // 2
            b = (p - first[d]) // half
            later = b > 0
            key = np.concatenate([(d << 32) + b, (d[later] << 32) + b[later] - 1])
            r = np.concatenate([r, r[later]])
            wanted = np.unique(key[starts[r]])  # blocks with a prefix token
            if not len(wanted):
                continue
            at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
            here = wanted[at] == key
            pair = np.unique(at[here] * len(vocabulary) + r[here])  # distinct tokens of each block, rarest first
            block, r = pair // len(vocabulary), pair % len(vocabulary)
            head = np.searchsorted(block, np.arange(len(wanted) + 1))
            place = np.arange(len(r)) - head[block]
            tried = set()
            for x in np.flatnonzero(starts[r]).tolist():
                w, j = int(block[x]), int(place[x])
                n = int(head[w + 1] - head[w])
                for i, k in prefix[int(r[x])]:
                    need = self.templates[i].need
                    if n >= need and j <= n - need and min(len(self.sets[i]) - k, n - j) >= need and (w, i) not in tried:
                        tried.add((w, i))
                        common = int(self.member[i][r[head[w]:head[w + 1]]].sum())
                        if common >= need:
                            text, at_word = int(wanted[w]) >> 32, (int(wanted[w]) & 0xFFFFFFFF) * half
                            end = min(at_word + size, int(first[text + 1] - first[text]))
                            yield text, i, at_word, end, common / len(self.sets[i])

    def places(self, rank: np.ndarray, template: int, begin: int, end: int) -> list[int]:
        """Words in [begin, end) from which the words of a template stand consecutively."""
        words = self.words[template]
        n = end - begin - len(words) + 1
        ok = np.ones(max(0, n), bool)
        for k, w in enumerate(words):
            ok &= rank[begin + k:begin + k + len(ok)] == w
        return (begin + np.flatnonzero(ok)).tolist()


def find_blocks(docs: DataFrame, found: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, template, label, first_word, n_words, containment): every block that meets a template.

    Null and empty texts have no block; a null id stays null; repeated rows each give their blocks."""
    tune(docs.sparkSession)
    found = templates() if found is None else found
    joiner = Joiner(found, frequencies(docs, found, text_col))
    names = [id_col, "template", "label", "first_word", "n_words", "containment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank, first = joiner.ranks([(t or "").encode("utf-8").translate(H.LOWER) for t in b.column(1).to_pylist()])
            ids = b.column(0).to_pylist()
            rows = [(ids[d], i, found[i].label, w, end - w, c) for d, i, w, end, c in joiner.blocks(rank, first)]
            for x in range(0, len(rows), ARROW_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[x:x + ARROW_ROWS]), types)], names)

    types = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.float64())
    frame = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_t"))
    return frame.mapInArrow(run, f"`{id_col}` long, template int, label string, first_word long, n_words long, containment double")


def scan(docs: DataFrame, found: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, n_base (places of phrases), first_word and last_word (their smallest and
    largest start), base_labels, labels (with those of the notices) and score (the best containment).

    Places are looked for in the blocks that the join finds.  A null or empty text has no words, no labels (an
    empty string), null places and a score of 0; a null id stays null; repeated rows are scanned each; an empty table gives
    no rows; columns other than the two named are ignored."""
    tune(docs.sparkSession)
    found = templates() if found is None else found
    joiner = Joiner(found, frequencies(docs, found, text_col))
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank, first = joiner.ranks([(t or "").encode("utf-8").translate(H.LOWER) for t in b.column(1).to_pylist()])
            places, base, labels, best = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(float)
            for d, i, w, end, c in joiner.blocks(rank, first):
                if found[i].phrase:
                    at = joiner.places(rank, i, int(first[d]) + w, int(first[d]) + end)
                    if not at:
                        continue
                    places[d].update((x - int(first[d]), i) for x in at)
                    base[d].add(found[i].label)
                labels[d].add(found[i].label)
                best[d] = max(best[d], c)
            rows = []
            for d, doc in enumerate(b.column(0).to_pylist()):
                at = [x for x, _ in places[d]]
                rows.append((doc, int(first[d + 1] - first[d]), len(at), min(at, default=None), max(at, default=None),
                             ",".join(sorted(base[d])), ",".join(sorted(labels[d])), best[d]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    frame = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_t"))
    return frame.mapInArrow(run, f"`{id_col}` long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def oracle() -> str:
    """The same in DuckDB SQL over the table documents, without the filters: all blocks that hold a template's token."""
    found = templates()
    tokens = ",\n    ".join(f"({i}, '{t.label}', {t.need}, {len(set(t.words))}, {t.size // 2}, {str(t.phrase).lower()}, '{w}')"
                            for i, t in enumerate(found) for w in sorted(set(t.words)))
    phrases = ",\n    ".join(f"('{t.label}', {list(t.words)})" for t in found if t.phrase)
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (0x41, 0x61))
    return rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM docs),
tokens(template, label, need, n, half, phrase, word) AS (VALUES
    {tokens}),
phrases(label, p) AS (VALUES
    {phrases}),
hits AS (SELECT doc_id, template, pos // half AS b, word FROM words JOIN tokens USING (word)),
blocks AS (SELECT * FROM hits UNION ALL SELECT doc_id, template, b - 1, word FROM hits WHERE b > 0),
met AS (SELECT doc_id, template, count(DISTINCT word) AS common FROM blocks GROUP BY doc_id, template, b),
notices AS (
  SELECT doc_id, label, common / n AS score FROM met JOIN (SELECT DISTINCT template, label, need, n, phrase FROM tokens) USING (template)
  WHERE common >= need AND NOT phrase),
places AS (
  SELECT doc_id, label, pos, 1.0::DOUBLE AS score FROM words JOIN phrases ON word = p[1] JOIN docs USING (doc_id) WHERE w[pos + 1:pos + len(p)] = p),
base AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id),
every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM (SELECT doc_id, label, score FROM notices UNION ALL SELECT doc_id, label, score FROM places) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)
"""
