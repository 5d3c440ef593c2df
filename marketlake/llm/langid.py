"""Operator 2: language identification by compression.

Every text is cut into pieces and each piece is compressed with one raw-content zstandard
dictionary per language; the language whose dictionary gives the fewest bytes over the whole
text wins.  A narrow margin between the two best is a rejection.
"""

from __future__ import annotations

import math

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import map_batches

#: Training text per language: a dictionary of at most this many bytes, from a sample of about
#: SAMPLE_DOCS whole documents of at most DOC_BYTES each (longer ones only where a language has no other).
DICT_BYTES = 96 << 10
SAMPLE_DOCS = 300
DOC_BYTES = 4 << 10
#: All dictionaries together; beyond it each becomes smaller.
TOTAL_BYTES = 32 << 20
#: Bytes compressed at a time: short enough that the dictionary, not the text, is matched.
PIECE = 1500
LEVEL = 9
#: Bytes that the runner-up must need beyond the best, for each 100 bytes of the best.
MARGIN = 4.0
#: Whole bytes measure a text of fewer bytes coarsely: its sizes under SLICES parts of each dictionary are added.
SHORT, SLICES = 300, 8


def learn(docs: DataFrame, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", dict_bytes: int = DICT_BYTES, sample_docs: int = SAMPLE_DOCS, doc_bytes: int = DOC_BYTES) -> dict[str, bytes]:
    """A dictionary per language that occurs in the labelled rows (``where`` may narrow them).

    The sample is bounded: whole documents of at most ``doc_bytes`` are picked by a hash of their id,
    about ``sample_docs`` a language.  Rows without text or language teach nothing."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows if where is None else rows.filter(where)
    size = F.octet_length(text_col)
    counts = {r["k"]: r for r in rows.groupBy(F.col(lang_col).alias("k")).agg(  # a row a language
        F.count("*").alias("n"), F.count_if(size <= doc_bytes).alias("short"), F.min(size).alias("least")).collect()}
    if not counts:
        return {}
    dict_bytes = min(dict_bytes, TOTAL_BYTES // len(counts))
    pick = lambda f: F.create_map(*[x for k, r in counts.items() for x in (F.lit(k), F.lit(f(r)))])[F.col(lang_col)]
    limit = pick(lambda r: doc_bytes if r["short"] else r["least"])
    share = pick(lambda r: min(1.0, sample_docs / (r["short"] or 1)))
    coin = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)) / 1_000_000
    picked = rows.filter((size <= limit) & (coin < share)).select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col), F.lit(7)).alias("o"), F.col(text_col).alias("text"))
    rows = sorted((r.lang, r.o, fold(r.text) + b" ") for r in picked.limit(4 * sample_docs * len(counts)).collect())
    return _pack(_agreed(rows, dict_bytes), dict_bytes)


def _agreed(rows: list[tuple], dict_bytes: int) -> list[tuple]:
    """Passages whose label the other half of the sample doesn't clearly contradict: foreign
    passages and wrong labels teach nothing."""
    halves = [[(lang, o, part) for lang, o, data in half for part in _passages(data)] for half in (rows[::2], rows[1::2])]
    kept = []
    for half, other in zip(halves, halves[::-1]):
        c = Compressors(_pack(other, dict_bytes))
        kept += [r for r in half if not c.contradicts(r[2], r[0])]
    return sorted(kept, key=lambda r: r[:2])


def _passages(data: bytes, size: int = 240) -> list[bytes]:
    """Folded text in pieces of some words."""
    out, words, n = [], [], 0
    for w in data.split():
        words.append(w)
        n += len(w) + 1
        if n >= size:
            out.append(b" ".join(words) + b" ")
            words, n = [], 0
    return out + ([b" ".join(words) + b" "] if words else [])


def _pack(rows: list[tuple], dict_bytes: int) -> dict[str, bytes]:
    out: dict[str, bytearray] = {}
    for lang, _, data in rows:
        room = out.setdefault(lang, bytearray())
        room += data[:max(0, dict_bytes - len(room))]
    return {k: bytes(v) for k, v in sorted(out.items())}


#: ASCII bytes that are no letters become spaces.
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def fold(text: str) -> bytes:
    """Lower-cased UTF-8 with runs of ASCII digits, marks and white space as one space."""
    return b" ".join(text.lower().encode("utf-8").translate(_LETTERS).split())


class Compressors:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.langs, self.dictionaries, self.level = list(dictionaries), dictionaries, level
        self.by, self.parts = [], None
        for data in dictionaries.values():
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def sizes(self, data: bytes, step: int = PIECE) -> list[int]:
        sizes = [0] * len(self.by)
        for i in range(0, len(data), step):
            piece = data[i:i + step]
            for k, compress in enumerate(self.by):
                sizes[k] += len(compress(piece))
        return sizes

    def contradicts(self, data: bytes, lang: str) -> bool:
        """Is another language clearly smaller than ``lang``?"""
        sizes = dict(zip(self.langs, self.sizes(data)))
        return lang in sizes and sizes[lang] > 1.02 * min(sizes.values())

    def classify(self, text: str | None, margin: float = MARGIN) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, rejected).  ``und`` without a letter."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        data = fold(text)
        sizes = self.sizes(data)
        best, relative = self._best(sizes)
        if len(data) < SHORT:
            for part in self._slices():
                sizes = [a + b for a, b in zip(sizes, part.sizes(data))]
            best, relative = self._best(sizes)
        return self.langs[best], 1 - math.exp(-relative / 4), len(sizes) > 1 and relative < margin

    def _slices(self) -> list["Compressors"]:
        """Compressors over SLICES parts of the dictionaries."""
        if self.parts is None:
            cut = lambda d, i: d[i * len(d) // SLICES:(i + 1) * len(d) // SLICES]
            self.parts = [Compressors({k: cut(d, i) or d for k, d in self.dictionaries.items()}, self.level) for i in range(SLICES)]
        return self.parts

    def _best(self, sizes: list[int]) -> tuple[int, float]:
        """The smallest (first among equals) and how many % more bytes the next one takes."""
        best = min(range(len(sizes)), key=lambda k: (sizes[k], self.langs[k]))
        gap = min([s for k, s in enumerate(sizes) if k != best], default=2 * sizes[best]) - sizes[best]
        return best, 100 * gap / max(1, sizes[best])


def identify(df: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", keep: list[str] | None = None,
             margin: float = MARGIN) -> DataFrame:
    """``df`` with lang_pred, score and rejected for every whole text.

    A null, empty or letterless text gives ``und``, 0.0 and a rejection.  Equal sizes go to the
    first language in order and are rejected.  Without dictionaries everything is ``und``."""
    box = df.sparkSession.sparkContext.broadcast(dictionaries)  # at most TOTAL_BYTES

    def make():
        c = Compressors(box.value)
        return lambda texts: list(zip(*[c.classify(t, margin) for t in texts]))

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("rejected", T.BooleanType())]
    return map_batches(df, keep or df.columns, [text_col], fields, make)
