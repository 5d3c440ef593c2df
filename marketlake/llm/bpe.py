"""Operator 10: byte-level BPE encoding and decoding by monoid tree reduction.

A pre-token's bytes are encoded as a balanced tree: halves are encoded on their own and
neighbours are joined by re-encoding a window of tokens around the seam.  The window grows
until the tokens next to it are provably stable: a token sequence is the BPE encoding of its
bytes exactly if every adjacent pair encodes back to itself, so once the two pairs at the
window's edges do, all pairs of the joined sequence do.  Decoding concatenates token bytes
up a balanced tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from array import array
from itertools import chain, islice

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlake.llm.common import map_batches

#: Bytes merged directly, without a split; the tree's leaves.
LEAF = 16
#: Short pre-tokens and adjacent pairs remembered by a worker, at most twice as many pre-tokens.
CACHE = 150_000
SHORT = 32
_LONG = 64
_NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64 token, space, rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class TreeBpe:
    """Encoder and decoder for one table of ranks and one pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {r: t for t, r in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self)

    def merge(self, data: bytes) -> list[int]:
        """Direct BPE: the lowest-ranked pair first, the leftmost among equals."""
        if data in self.ranks:
            return [self.ranks[data]]
        if len(data) > _LONG:
            return self._merge_long(data)
        get, n = self.ranks.get, len(data)
        parts = [data[i:i + 1] for i in range(n)]
        pairs = [get(data[i:i + 2], _NONE) for i in range(n - 1)]
        while pairs and (best := min(pairs)) != _NONE:
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], _NONE)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], _NONE)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same merges through a heap and a linked list: n log n."""
        ranks, n = self.ranks, len(data)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def stable(self, a: int, b: int) -> bool:
        """Does the pair (a, b) encode back to itself?"""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded neighbours' bytes together."""
        if not left or not right:
            return left or right
        if self.stable(left[-1], right[0]):
            return left + right
        k = 1
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            window = self.merge(b"".join(map(self.token.__getitem__, left[a:] + right[:b])))
            if (a == 0 or self.stable(left[a - 1], window[0])) and (b == len(right) or self.stable(window[-1], right[b])):
                return left[:a] + window + right[b:]
            k *= 2

    def encode_piece(self, data: bytes) -> list[int]:
        """One pre-token: halves encoded recursively, then joined.

        The left half is a power of two of leaves, so that both halves of a periodic run
        break at the same places and few windows have to grow."""
        if len(data) <= LEAF:
            return self.merge(data)
        mid = LEAF << (((len(data) - 1) // LEAF).bit_length() - 1)
        return self.join(self.encode_piece(data[:mid]), self.encode_piece(data[mid:]))

    def encode(self, text: str) -> array:
        """Token ids of a whole text; no special tokens."""
        ids, found = array("I"), self.pattern.finditer(text) if len(text) > 1 << 20 else None
        if found is None:
            ids.extend(chain.from_iterable(map(self.pieces.__getitem__, self.pattern.findall(text))))
            return ids
        while block := [m.group() for m in islice(found, 65536)]:
            ids.extend(chain.from_iterable(map(self.pieces.__getitem__, block)))
        return ids

    def decode(self, ids) -> bytes:
        """Token bytes concatenated up a balanced tree."""
        if len(ids) <= 4096:
            return b"".join(map(self.token.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


class _Pieces(dict):
    """Encodings of short pre-tokens in two generations: a full young one becomes the old one."""

    def __init__(self, bpe: TreeBpe):
        self.bpe, self.old = bpe, {}

    def __missing__(self, piece: str):
        ids = self.old.get(piece)
        if ids is None:
            ids = tuple(self.bpe.encode_piece(piece.encode("utf-8")))
        if len(piece) <= SHORT:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def _shared(df: DataFrame, ranks_path: str, pattern: str | None):
    import public_tokenizers

    box = df.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))  # one vocabulary file: bounded
    pattern = pattern or public_tokenizers.PATTERN
    return lambda: TreeBpe(box.value, pattern)


def encode(df: DataFrame, ranks_path: str, text_col: str = "text", pattern: str | None = None,
           out_col: str = "ids") -> DataFrame:
    """``df`` with ``out_col`` array<int>: the token ids of every whole text.

    A null or empty text gives an empty array; repeated rows repeat their result; an empty
    table stays empty; an input column named ``out_col`` is replaced."""
    make_bpe = _shared(df, ranks_path, pattern)

    def make():
        bpe = make_bpe()
        return lambda texts: [[bpe.encode(t or "").tolist() for t in texts]]

    return map_batches(df, df.columns, [text_col], [T.StructField(out_col, T.ArrayType(T.IntegerType()))], make)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col`` binary: the bytes of every array of token ids (null as empty)."""
    make_bpe = _shared(df, ranks_path, None)

    def make():
        bpe = make_bpe()
        return lambda rows: [[bpe.decode(r or []) for r in rows]]

    return map_batches(df, df.columns, [ids_col], [T.StructField(out_col, T.BinaryType())], make)


def round_trip(df: DataFrame, ranks_path: str, text_col: str = "text", keep: list[str] | None = None,
               pattern: str | None = None) -> DataFrame:
    """Encode and decode every whole text; keep counts and digests instead of the ids.

    Adds n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers),
    decoded_sha256 (decoded bytes) and lossless (decoded bytes equal the text's)."""
    make_bpe = _shared(df, ranks_path, pattern)
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType()), T.StructField("lossless", T.BooleanType())]

    def make():
        bpe = make_bpe()

        def f(texts):
            out = [[], [], [], []]
            for t in texts:
                ids = bpe.encode(t or "")
                back = bpe.decode(ids)
                for col, v in zip(out, (len(ids), hashlib.sha256(little_endian(ids)).hexdigest(),
                                        hashlib.sha256(back).hexdigest(), back == (t or "").encode("utf-8"))):
                    col.append(v)
            return out

        return f

    return map_batches(df, keep or df.columns, [text_col], fields, make)
