"""Operator 10 against the tiktoken library, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from marketlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = bpe.load_ranks(PATH)
    return bpe.TreeBpe(ranks, public_tokenizers.PATTERN), tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_on_random_texts(both):
    mine, ref = both
    rng = random.Random(3)
    alphabet = ["ab", "aab ", "the", "é", "日本語", " ", "\n", "0", "xxxxx", "🙂", "abcabc", "ing", "<|endoftext|>", "'s"]
    for _ in range(1500):
        s = "".join(rng.choice(alphabet[:rng.randint(1, len(alphabet))]) for _ in range(rng.randint(0, 150)))
        s = s.replace(" ", "") if rng.random() < 0.5 else s
        ids = mine.encode(s)
        assert list(ids) == ref.encode_ordinary(s)
        assert mine.decode(ids) == s.encode()


@pytest.mark.parametrize("piece", ["a" * 30_000, "ab" * 9_000, "".join(random.Random(1).choice("abcdefgh") for _ in range(40_000)), "-" * 9_999])
def test_long_pieces(both, piece):
    mine, ref = both
    assert mine.encode_piece(piece.encode()) == ref.encode_ordinary(piece)


def test_frames(docs_df, both):
    rows = [(1, "Hello wörld"), (2, ""), (3, None), (4, "Hello wörld"), (None, "x")]
    df = docs_df(rows)
    out = {r["doc_id"]: r for r in bpe.round_trip(df, PATH).collect()}
    for i, t in rows:
        ids = both[1].encode_ordinary(t or "")
        want = hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        assert (out[i]["n_tokens"], out[i]["ids_sha256"], out[i]["lossless"]) == (len(ids), want, True)
    back = bpe.decode(bpe.encode(df.withColumnRenamed("doc_id", "ids"), PATH, out_col="tok"), PATH, ids_col="tok")
    assert sorted((bytes(r["decoded"]).decode() for r in back.collect())) == sorted(t or "" for _, t in rows)
    assert bpe.encode(docs_df([]), PATH).count() == 0
    assert bpe.encode(df.withColumnRenamed("doc_id", "ids"), PATH).columns == ["text", "ids"]  # a clashing column is replaced
