import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerline.llm import bpe
from ledgerline.llm.q_bpe import RANKS, tokenizer


@pytest.fixture(scope="module")
def pair():
    with open(public_tokenizers.path(RANKS), "rb") as f:
        codec = bpe.Codec(f.read(), public_tokenizers.PATTERN)
    return codec, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks,
                                    special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_equals_the_library_on_random_texts(pair):
    codec, library = pair
    rng = random.Random(3)
    letters = "abcdefghij  \n\t\r\x0b\x1c\x85 　éßñ漢字仮名\U0001f600'sll123!?.-_ ́​İſ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(800)]
    for t, packed in zip(texts, codec.encode(texts)):
        assert ids(packed) == library.encode_ordinary(t)
        assert codec.decode(ids(packed)) == t.encode()


def test_long_pieces(pair):
    codec, library = pair
    rng = random.Random(4)
    texts = ["a" * 5000, "ab" * 3000, "abcab" * 2000, "漢" * 3000, " " * 4000, "\n" * 999 + "x", "!" * 700 + "?",
             *("".join(rng.choice(s) for _ in range(6000)) for s in ("abcde", "etaoinsh", "<>/=-"))]
    for t, packed in zip(texts, codec.encode(texts)):
        assert ids(packed) == library.encode_ordinary(t)


def test_pieces_beyond_the_kept_table(pair, monkeypatch):
    codec, library = pair
    monkeypatch.setattr(bpe, "KEPT_PIECES", 5)
    for k in range(4):
        texts = [f"word{k}a word{j}b the the" for j in range(20)]
        assert [ids(p) for p in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_pair_table_finds_every_pair_and_no_other():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 500, (3000, 2)), axis=0)
    table = bpe.PairTable(keys[:, 0], keys[:, 1], np.arange(len(keys), dtype=np.int32))
    assert (table(keys[:, 0], keys[:, 1]) == np.arange(len(keys))).all()
    assert (table(keys[:, 0] + 1000, keys[:, 1]) == bpe.NO_RANK).all()


def test_odd_rows(spark, odd, none, pair):
    t = tokenizer(spark)
    assert sorted(bpe.encode(odd, t).columns) == sorted(odd.columns)
    for r in bpe.decode(bpe.round_trip(odd, t), t).collect():
        raw = (r["text"] or "").encode()
        assert r["ids"] == pair[1].encode_ordinary(r["text"] or "")
        assert bytes(r["bytes"]) == raw and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(raw).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], dtype="<u4").tobytes()).hexdigest()
    assert bpe.decode(bpe.encode(none, t), t).count() == 0 and bpe.round_trip(none, t).count() == 0
    one = spark.createDataFrame([(1, None)], "k long, ids array<int>")
    assert bytes(bpe.decode(one, t).first()["bytes"]) == b""
