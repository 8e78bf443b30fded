"""Benchmark decontamination: token windows against a broadcast hash set.

A window is ``width`` consecutive words of a benchmark item (an item with
fewer words is one window).  Words are numbered by the benchmark's own
vocabulary, a document becomes a row of these numbers (-1 for any other word),
and the rolling hash of each window is looked up in the set of benchmark
window hashes.  A hit is verified by comparing the word numbers themselves.

Only the benchmark is broadcast.  Its size is measured first: beyond
``max_words`` words it is cut into shards of items, and the documents pass
once by every shard, each broadcast in its turn: the rows are checkpointed
between the passes, a pass a job that runs when called, and the broadcast is
dropped.  The hits of all passes are merged row by row, so there is no shuffle
at any size.

Defined cases: a null text has no words; null or empty benchmark texts have no
windows; an item without an id marks words but is not listed; equal item ids
are listed once; repeated documents are judged one by one; columns named like
an output are replaced, others pass through; empty tables on either side give
no hits.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.batches import map_batches, texts
from ledgerline.llm.common import aside, cut, lower_ascii, text_of

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")      # on lower-cased UTF-8: digits, a-z, all beyond ASCII
_COMMON = np.uint64(0x9E3779B97F4A7C15)
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


def _roll(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive numbers."""
    n = len(ids) - width + 1
    v = (ids.astype(np.uint64) + np.uint64(1)) * _COMMON
    v ^= v >> np.uint64(29)
    h = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width):
        h = (h * np.uint64(0x100000001B3)) ^ v[k:k + len(h)]
    return h


class WindowIndex:
    """Vocabulary, window hashes and the windows themselves of some benchmark items."""

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[int, dict[bytes, set[str | None]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in _words(text)], dtype=np.int32)
            size = min(width, len(ids))
            for k in range(len(ids) - size + 1 if size else 0):
                owners[size][ids[k:k + size].tobytes()].add(item)
        self.owners = {size: dict(w) for size, w in owners.items()}
        self.hashes = {size: np.unique(np.concatenate([_roll(np.frombuffer(w, dtype=np.int32), size) for w in ws]))
                       for size, ws in self.owners.items()}

    def hits(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit word ranges (merged, end exclusive), items."""
        get = self.vocabulary.get
        low = text.encode().lower()
        ids = np.fromiter((get(m.group(), -1) for m in _WORD.finditer(low)), dtype=np.int32)
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        for size, known in self.hashes.items():
            if len(ids) < size:
                continue
            gap = np.concatenate([[0], np.cumsum(ids < 0)])
            at = np.flatnonzero(gap[size:] == gap[:-size])           # windows of benchmark words only
            if not len(at):
                continue
            rolled = _roll(ids, size)[at]
            place = np.minimum(np.searchsorted(known, rolled), len(known) - 1)
            for k in at[known[place] == rolled].tolist():
                owner = self.owners[size].get(ids[k:k + size].tobytes())
                if owner is not None:
                    ranges.append((k, k + size))
                    items.update(i for i in owner if i is not None)
        return len(ids), merge(ranges), items


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _shards(benchmark: DataFrame, item: str, text: str, max_words: int) -> list[DataFrame]:
    """The benchmark in parts of about ``max_words`` words at most."""
    b = benchmark.select(F.col(item).cast("string").alias("item"), text_of(text).alias("text"))
    total = b.agg(F.sum(F.regexp_count(lower_ascii(F.col("text")), F.lit(WORDS)))).first()[0] or 0
    n = max(1, -(-total // max_words))
    if n == 1:
        return [b]
    n *= 2      # hashing leaves the parts uneven
    return [b.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


ADD = "n_words long, hit_ranges array<struct<start:long,end:long>>, hit_items array<string>"


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item: str = "item_id",
               item_text: str = "text", max_words: int = 2_000_000) -> DataFrame:
    """``docs`` with n_words, hit_ranges (word numbers, end exclusive) and hit_items (sorted)."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    sc = docs.sparkSession.sparkContext
    shards = _shards(benchmark, item, item_text, max_words)
    for turn, part in enumerate(shards):
        index = sc.broadcast(WindowIndex([(r["item"], r["text"]) for r in part.collect()], width))

        def run(batch, index=index, turn=turn):
            n, ranges, items = [], [], []
            for i, t in enumerate(texts(batch, text)):
                words, hit, owners = index.value.hits(t)
                if turn:
                    hit = merge(hit + [(x["start"], x["end"]) for x in batch.column("hit_ranges")[i].as_py()])
                    owners |= set(batch.column("hit_items")[i].as_py())
                n.append(words)
                ranges.append([{"start": a, "end": b} for a, b in hit])
                items.append(sorted(owners))
            return {"n_words": pa.array(n, pa.int64()), "hit_ranges": pa.array(ranges, span),
                    "hit_items": pa.array(items, pa.list_(pa.string()))}

        docs = map_batches(docs, run, ADD, text)
        if turn + 1 < len(shards):       # one index at a time: this one is done before the next is built
            docs = cut(docs)
            index.destroy()
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "drop", text: str = "text", **options) -> DataFrame:
    """``docs`` without contaminated documents (``drop``) or without the hit words (``cut``)."""
    if mode not in ("drop", "cut"):
        raise ValueError(f"mode {mode!r} is neither drop nor cut")
    docs, back = aside(docs, [f.split()[0] for f in ADD.split(", ")])
    columns = docs.columns
    found = find_leaks(docs, benchmark, text=text, **options)
    if mode == "drop":
        return found.where(F.size("hit_ranges") == 0).select(*columns).withColumnsRenamed(back)

    def run(batch):
        out = []
        for i, t in enumerate(batch.column(text).to_pylist()):
            hit = batch.column("hit_ranges")[i].as_py()
            if hit:
                raw = t.encode()
                at = [m.span() for m in _WORD.finditer(raw.lower())]
                parts, free = [], 0
                for h in hit:
                    parts.append(raw[free:at[h["start"]][0]])
                    free = at[h["end"] - 1][1]
                t = b"".join([*parts, raw[free:]]).decode()
            out.append(t)
        return {text: pa.array(out, pa.string())}
    return map_batches(found, run, f"`{text}` string", text).select(*columns).withColumnsRenamed(back)
