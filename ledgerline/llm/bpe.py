"""Byte-level BPE encoding and decoding in padded numpy matrices.

A text is split by the tokenizer's pattern; pieces that a worker has met are
looked up, new ones are encoded together.  They are bucketed by byte length
into matrices of token ids, and in each round every row merges its leftmost
pair of least rank.  The rank of a pair comes from an open-addressing hash
table of all pairs of the vocabulary, and each merge compacts its row by one
cell, so a matrix shrinks by one column a round; rows with nothing left to
merge leave it.  A piece longer than ``LONG`` bytes is a bucket of its own in
which one round merges every occurrence of the least rank, as long as this
equals merging them one by one.

The rank file (``base64 rank`` lines) is a parameter.  The driver reads it and
broadcasts its bytes; its size is bounded by ``MAX_VOCABULARY_BYTES`` and does
not depend on the corpus.

Defined cases: a null text is an empty text and has no tokens; repeated rows
are encoded one by one with equal results; a column named like an output is
replaced, others pass through; an empty table gives an empty table; decoding a
null id list gives empty bytes.  Whole texts are encoded whatever their length.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerline.llm.batches import map_batches, ragged, texts

MAX_VOCABULARY_BYTES = 64 << 20
NO_RANK = np.int32(2**31 - 1)
LONG = 128
KEPT_PIECES = 200_000       # a worker's table of pieces is emptied beyond this
KEPT_PIECE_CHARS = 64

_EMPTY = np.uint64(2**64 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank of a pair of token ids, by open addressing with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(len(rank), 1) * 4))))
        self._shift = np.uint64(64 - bits)
        self._mask = np.int64((1 << bits) - 1)
        self._keys = np.full(1 << bits, _EMPTY, dtype=np.uint64)
        self._rank = np.full(1 << bits, NO_RANK, dtype=np.int32)
        keys = self._key(left, right)
        slot = self._slot(keys)
        left_over = np.arange(len(keys))
        while len(left_over):
            s = slot[left_over]
            free = self._keys[s] == _EMPTY
            self._keys[s[free]] = keys[left_over[free]]          # of rivals for a slot one stays
            placed = self._keys[s] == keys[left_over]
            self._rank[s[placed]] = rank[left_over[placed]]
            left_over = left_over[~placed]
            slot[left_over] = (slot[left_over] + 1) & self._mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> self._shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._key(left.ravel(), right.ravel())
        slot = self._slot(keys)
        found = self._keys[slot]
        out = np.where(found == keys, self._rank[slot], NO_RANK)
        todo = np.flatnonzero((found != keys) & (found != _EMPTY))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self._mask
            found = self._keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self._rank[slot[todo[hit]]]
            todo = todo[~hit & (found != _EMPTY)]
        return out.reshape(left.shape)


class Pieces(dict):
    """Ids of known pieces; the long ones of the batch at hand stand aside and are not kept."""

    def __init__(self):
        super().__init__()
        self.long: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        return self.long[piece]


class Codec:
    """One vocabulary: pieces to ids, ids to bytes."""

    def __init__(self, rank_file: bytes, pattern: str):
        ranks: dict[bytes, int] = {}
        for line in rank_file.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self._byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self._pairs = PairTable(np.array(left, dtype=np.int64), np.array(right, dtype=np.int64),
                                np.array(rank, dtype=np.int32))
        self._split = regex.compile(pattern).findall
        self._known = Pieces()

    def encode(self, batch: list[str]) -> list[bytes]:
        """For each text its ids, packed as little-endian unsigned 32-bit integers."""
        pieces = [self._split(t) for t in batch]
        known = self._known
        new = set().union(*pieces).difference(known)
        known.long = {}
        for p, ids in zip(new, self._encode_pieces([p.encode() for p in new])):
            (known if len(p) <= KEPT_PIECE_CHARS else known.long)[p] = ids
        out = [b"".join(map(known.__getitem__, p)) for p in pieces]
        if len(known) > KEPT_PIECES:
            known.clear()
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(p) > LONG:
                out[i] = self._merge_long(p)
            else:
                buckets.setdefault(len(p), []).append(i)
        for width, rows in buckets.items():
            raw = np.frombuffer(b"".join(pieces[i] for i in rows), dtype=np.uint8).reshape(len(rows), width)
            self._merge_rows(self._byte_ids[raw], rows, out)
        return out

    def _merge_rows(self, ids: np.ndarray, rows: list[int], out: list[bytes]) -> None:
        """Rounds over one matrix; all of its rows have the same number of ids."""
        where = np.array(rows)
        rank = self._pairs(ids[:, :-1], ids[:, 1:])
        while len(where):
            best = rank.min(axis=1) if rank.shape[1] else np.full(len(where), NO_RANK)
            done = best == NO_RANK
            if done.any():
                for i, row in zip(where[done].tolist(), ids[done].astype("<u4")):
                    out[i] = row.tobytes()
                ids, rank, where, best = ids[~done], rank[~done], where[~done], best[~done]
                if not len(where):
                    return
            n, width = ids.shape
            at, row = rank.argmin(axis=1), np.arange(n)
            ids[row, at] = best
            keep = np.ones((n, width), dtype=bool)
            keep[row, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), dtype=bool)
            keep[row, at] = False
            rank = rank[keep].reshape(n, width - 2)
            for shift in (-1, 0):       # the two pairs that hold the merged id
                k = at + shift
                r = row[(k >= 0) & (k < width - 2)]
                k = k[(k >= 0) & (k < width - 2)]
                rank[r, k] = self._pairs(ids[r, k], ids[r, k + 1])

    def _merge_long(self, piece: bytes) -> bytes:
        """One long piece: every occurrence of the least rank in one round.

        Left to right without overlap, this is what single merges give unless
        a pair with a merged id has a still lower rank; then only the leftmost
        pair is merged.
        """
        ids = self._byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        while len(ids) > 1:
            rank = self._pairs(ids[:-1], ids[1:])
            best = rank.min()
            if best == NO_RANK:
                break
            at = np.flatnonzero(rank == best)
            if len(at) > 1:
                run = np.cumsum(np.concatenate([[0], np.diff(at) != 1]))     # runs of overlapping pairs
                first = np.concatenate([[True], np.diff(run) != 0])
                start = np.maximum.accumulate(np.where(first, at, 0))
                at = at[(at - start) % 2 == 0]
            merged = self._merged(ids, at, best)
            if len(at) > 1 and self._pairs(merged[:-1], merged[1:]).min(initial=NO_RANK) < best:
                merged = self._merged(ids, at[:1], best)
            ids = merged
        return ids.astype("<u4").tobytes()

    @staticmethod
    def _merged(ids: np.ndarray, at: np.ndarray, to: np.int32) -> np.ndarray:
        out = ids.copy()
        out[at] = to
        return np.delete(out, at + 1)


@functools.lru_cache(maxsize=2)
def _codec(rank_file: bytes, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


class Tokenizer:
    """The rank file of a public tokenizer, sent once to every executor."""

    def __init__(self, spark, path: str, pattern: str):
        data = Path(path).read_bytes()
        if len(data) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"rank file of {len(data)} bytes is over {MAX_VOCABULARY_BYTES}")
        self._data, self._pattern = spark.sparkContext.broadcast(data), pattern

    def __reduce__(self):
        return _rebuild, (self._data, self._pattern)

    @property
    def codec(self) -> Codec:
        return _codec(self._data.value, self._pattern)


def _rebuild(data, pattern) -> Tokenizer:
    t = Tokenizer.__new__(Tokenizer)
    t._data, t._pattern = data, pattern
    return t


def encode(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as array<int> in column ``out``."""
    def run(batch):
        packed = tokenizer.codec.encode(texts(batch, text))
        values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"))
        return {out: ragged(values, [len(p) // 4 for p in packed])}
    return map_batches(docs, run, f"`{out}` array<int>", text)


def _id_rows(column: pa.Array) -> Iterable[np.ndarray]:
    for i in range(len(column)):
        v = column[i].values
        yield np.empty(0, dtype=np.int32) if v is None else v.to_numpy(zero_copy_only=False)


def decode(coded: DataFrame, tokenizer: Tokenizer, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``coded`` with the bytes of each id list in column ``out``."""
    def run(batch):
        back = tokenizer.codec.decode
        return {out: pa.array([back(r.tolist()) for r in _id_rows(batch.column(ids))], type=pa.binary())}
    return map_batches(coded, run, f"`{out}` binary", ids)


ROUND_TRIP = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids") -> DataFrame:
    """Encode, and decode the ids again, in one pass over the batches.

    Adds the ids as :func:`encode` does, their number, and the SHA-256 of the
    ids (little-endian unsigned 32-bit integers) and of the bytes that they
    decode to, by which a reader of the tokens can check them.
    """
    def run(batch):
        codec = tokenizer.codec
        packed = codec.encode(texts(batch, text))
        numbers = [np.frombuffer(p, dtype="<i4") for p in packed]
        return {
            ids: ragged(pa.array(np.frombuffer(b"".join(packed), dtype="<i4")), [len(n) for n in numbers]),
            "n_tokens": pa.array([len(n) for n in numbers], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(codec.decode(n.tolist())).hexdigest() for n in numbers],
                                       pa.string())}
    return map_batches(docs, run, f"`{ids}` array<int>, {ROUND_TRIP}", text)
