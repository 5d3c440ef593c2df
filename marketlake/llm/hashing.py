"""Vectorised word splitting and hashing of many texts at once (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WBASE = 0xD6E8FEB86659FD93
#: Bytes hashed at a time, so that scratch arrays stay small whatever a text's length.
BLOCK = 1 << 20

#: Words [^\x20\x09-\x0D]+ of UTF-8 bytes.
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[0x20, *range(0x09, 0x0E)]] = False
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of UTF-8 bytes, after lower-casing A-Z.
ALNUM_WORDS = np.ones(256, bool)
ALNUM_WORDS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
#: A-Z to a-z and nothing else.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split(texts: list[bytes], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, word starts, word ends, first word of each text and the end), over all texts."""
    sep = b" " if not is_word[0x20] else b"\x00"
    buf = np.frombuffer(sep + sep.join(texts) + sep, np.uint8)
    inside = is_word[buf]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    begins = np.cumsum([1, *[len(t) + 1 for t in texts]])
    return buf, starts, ends, np.searchsorted(starts, begins)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, as uint64."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    cuts = np.searchsorted(starts, np.arange(starts[0], ends[-1], BLOCK))
    cuts = np.unique(np.append(cuts, len(starts)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        s, e = starts[a:b], ends[a:b]
        lens = e - s
        first = np.cumsum(lens) - lens
        within = np.arange(lens.sum()) - np.repeat(first, lens)
        power = np.cumprod(np.full(lens.max(), _BASE, np.uint64))
        terms = _BYTE[buf[within + np.repeat(s, lens)]] * power[within]
        out[a:b] = np.add.reduceat(terms, first) + lens.astype(np.uint64)
    return mix(out)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive entries (k <= len(h), else empty)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc, size, power, done = None, 0, h, 1
    # binary composition: hash(a + b) = hash(a) * B**len(b) + hash(b)
    while True:
        if k & done:
            if acc is None:
                acc, size = power, done
            else:
                m = len(h) - size - done + 1
                acc = acc[:m] * np.uint64(pow(_WBASE, done, 1 << 64)) + power[size:size + m]
                size += done
        if done * 2 > k:
            break
        m = len(power) - done
        power = power[:m] * np.uint64(pow(_WBASE, done, 1 << 64)) + power[done:done + m]
        done *= 2
    return mix(acc[:n])


def whole_windows(first: np.ndarray, n_words: int, k: int) -> np.ndarray:
    """True where the k words from a position on lie within one text."""
    ok = np.zeros(max(0, n_words - k + 1), bool)
    lens = np.diff(first)
    fits = lens >= k
    delta = np.zeros(n_words + 2, np.int32)
    np.add.at(delta, first[:-1][fits], 1)
    np.add.at(delta, first[1:][fits] - k + 1, -1)
    ok[:] = np.cumsum(delta)[:len(ok)] > 0
    return ok
