"""Exact substring deduplication with suffix sorting.

Every byte covered by a ``length``-byte string that also starts earlier
(smaller doc_id, or earlier in the same document) is removed; strings are
judged on the input and never cross documents.

A corpus has as many suffixes as bytes, so they are not all sorted.  Content
picks places first: of the ``gram``-byte hashes inside a ``length``-byte
string the least (the last of equal ones) is its anchor.  Equal strings have
equal anchors, so

1. a string whose anchor occurs once in the corpus occurs once (anchors are
   counted with partial sums);
2. the strings of one document that share an anchor are consecutive; they make
   a segment.  Equal segments are reduced to the first of them by partial
   aggregation, all others are removed whole;
3. anchors with several different segments are what is left.  Their suffixes
   are sorted, many anchors to a bucket, by the deep-shallow method: multikey
   sorting on 8-byte characters to a shallow depth, then a blind trie for each
   group that still shares its prefix.  Equal neighbours give the strings'
   first places;
4. an anchor with over ``max_group`` different segments (a passage that very
   many documents quote, each in words of its own) would not fit a task: its
   strings are grouped by their MD5 with partial sums and joined back, which
   spreads them evenly.

Segments are compared by two 64-bit hashes (anchor and content), sorted
strings by their bytes.

Defined cases: a null text is empty; rows with equal id and text are one
document and get the same result, each of them; rows with equal id and
different texts are told apart and ordered by a 64-bit hash of the text; a null id comes last; texts
shorter than ``length`` bytes lose nothing; an empty table gives an empty
table; extra columns are passed through.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm.batches import importable, map_batches, slices
from ledgerline.llm.common import text_of, written

CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random byte values, and the powers of the base and of its inverse."""
    values = np.random.default_rng(2024).integers(1, 2**63, 256, dtype=np.int64).view(np.uint64) | np.uint64(1)
    up = np.full(n, _BASE)
    up[0] = 1
    down = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    down[0] = 1
    return values, np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[:len(v) - (width - have)], v[width - have:]) if have < width else v


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int,
             whole: bool = True) -> Iterator[tuple[np.ndarray, ...]]:
    """Segments of the texts that ``data`` holds end to end: (place, count, anchor hash, content hash).

    Without ``whole`` only the anchor hash is made.
    ``place`` is that of the first string, ``count`` the number of strings.
    The bytes are read in chunks that overlap by a string, so memory does not
    grow with a text; a segment that a chunk cuts is two segments.
    """
    low = np.uint64((1 << 21) - 1)
    values, up, down = _powers(CHUNK + length + 1)
    starts = np.concatenate([[0], ends[:-1]])
    for c in range(0, max(len(data) - length + 1, 0), CHUNK):
        part = data[c:c + CHUNK + length - 1]
        n = len(part)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[part] * up[:n], out=total[1:])
        hashed = _mix((total[gram:] - total[:n + 1 - gram]) * down[:n + 1 - gram])
        place = np.arange(len(hashed), dtype=np.uint64)
        chosen = (low - (_least((hashed & ~low) | (low - place), length - gram + 1) & low)).astype(np.int64)
        strings = len(chosen)
        open_ = np.zeros(strings + 1, dtype=np.int32)            # strings that end within their text
        first, last = np.clip(starts - c, 0, strings), np.clip(ends - length + 1 - c, 0, strings)
        some = last > first
        np.add.at(open_, first[some], 1)
        np.add.at(open_, last[some], -1)
        valid = np.cumsum(open_[:-1]) > 0
        begins = np.ones(strings, dtype=bool)
        begins[1:] = (chosen[1:] != chosen[:-1]) | ~valid[:-1]
        begins[first[first < strings]] = True
        at = np.flatnonzero(begins & valid)
        if not whole:
            yield at, at, hashed[chosen[at]].view(np.int64), at
            continue
        stop = np.flatnonzero(np.concatenate([begins[1:] | ~valid[1:], [True]]) & valid) + 1
        count = stop - at
        end = stop - 1 + length
        content = _mix((total[end] - total[at]) * down[at] + count.astype(np.uint64))
        yield at + c, count, hashed[chosen[at]].view(np.int64), content.view(np.int64)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each row ends."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets[1:] - offsets[0]


def _segment_rows(docs: DataFrame, length: int, gram: int, whole: bool) -> DataFrame:
    """One row per segment: its anchor; if ``whole`` also its document, place, count and content hash."""
    schema = StructType.fromDDL("anchor long, content long, doc long, text_hash long, start long, count int"
                                if whole else "anchor long")
    # a null id stays null in column doc

    def run(batches):
        for batch in batches:
            for part in slices(batch, "data"):
                data, ends = _bytes_of(part.column("data"))
                for place, count, anchor, content in segments(data, ends, length, gram, whole):
                    if not whole:
                        yield pa.RecordBatch.from_arrays([pa.array(anchor)], names=schema.names)
                        continue
                    row = np.searchsorted(ends, place, side="right")
                    start = place - np.concatenate([[0], ends])[row]
                    of = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(content), part.column("doc").take(of),
                         part.column("text_hash").take(of), pa.array(start), pa.array(count.astype(np.int32))],
                        names=schema.names)
    data = text_of().cast("binary").alias("data")
    importable(docs.sparkSession)
    return docs.select(*(["doc", "text_hash"] if whole else []), data).mapInArrow(run, schema)


# -- deep-shallow sorting -----------------------------------------------------

def multikey(data: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``at`` by their first ``depth`` bytes, and the group of equal prefixes of each.

    Multikey sorting with characters of eight bytes: each round orders the
    groups that are still together by their next character.
    """
    order, group = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
    open_ = np.arange(len(at))                        # places in ``order`` of groups with company
    for d in range(0, depth, 8):
        if not len(open_):
            break
        rows = order[open_]
        key = data[at[rows][:, None] + np.arange(d, d + 8)].view(">u8").ravel().astype(np.uint64)
        if d + 8 > depth:
            key >>= np.uint64(8 * (d + 8 - depth))
        by = np.lexsort((key, group[open_]))
        order[open_], key = rows[by], key[by]
        fresh = np.zeros(len(at), dtype=bool)
        fresh[0] = True
        fresh[1:] = group[1:] != group[:-1]
        fresh[open_[1:]] |= key[1:] != key[:-1]
        group = np.cumsum(fresh) - 1
        size = np.bincount(group)
        open_ = np.flatnonzero(size[group] > 1)
    return order, group


class BlindTrie:
    """Strings of one length in a compacted trie that knows branching places and characters only.

    A string goes down blindly by the characters at the branching places; one
    comparison with the leaf reached tells how far it truly agrees, and there
    it is inserted.
    """

    def __init__(self, first: bytes, name: int):
        self._root: list = [None, first, [name]]          # leaf: [None, string, names]; node: [place, {char: child}]

    def add(self, s: bytes, name: int) -> None:
        node = self._root
        while node[0] is not None:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = node[1]
        if other == s:
            node[2].append(name)
            return
        differs = (int.from_bytes(s) ^ int.from_bytes(other)).bit_length()
        agree = len(s) - (differs + 7) // 8
        above, node = None, self._root
        while node[0] is not None and node[0] < agree:
            above, node = node, node[1][s[node[0]]]
        leaf = [None, s, [name]]
        if node[0] == agree:
            node[1][s[agree]] = leaf
            return
        fork = [agree, {s[agree]: leaf, other[agree]: node}]
        if above is None:
            self._root = fork
        else:
            above[1][s[above[0]]] = fork

    def sorted_names(self) -> Iterator[list[int]]:
        """Names of equal strings together, in the strings' order."""
        todo = [self._root]
        while todo:
            node = todo.pop()
            if node[0] is None:
                yield node[2]
            else:
                todo += [node[1][c] for c in sorted(node[1], reverse=True)]


TRIE_MOST = 2048      # larger groups stay with multikey sorting, whose memory is arrays only


def equal_groups(data: np.ndarray, at: np.ndarray, length: int, shallow: int = 32) -> np.ndarray:
    """A number for each ``length``-byte string at ``at``: equal for equal strings, in sorted order.

    ``data`` has eight bytes to spare at its end.
    """
    out = np.empty(len(at), dtype=np.int64)
    shallow = min(shallow, length)
    order, group = multikey(data, at, shallow)
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(at)]])
    size = np.diff(bounds)
    nth = np.zeros(len(at), dtype=np.int64)               # number within the group, in sorted order
    extra = np.zeros(len(size), dtype=np.int64)
    if shallow < length:
        pairs = np.flatnonzero(size == 2)                 # a trie of two leaves is one comparison
        a, b = order[bounds[pairs]], order[bounds[pairs] + 1]
        span = np.arange(shallow, length)
        for k in range(0, len(pairs), 1 << 16):
            x, y = a[k:k + (1 << 16)], b[k:k + (1 << 16)]
            left, right = data[at[x][:, None] + span], data[at[y][:, None] + span]
            differs = left != right
            apart = differs.any(axis=1)
            first = differs.argmax(axis=1)
            row = np.arange(len(x))
            larger = np.where(left[row, first] > right[row, first], x, y)
            nth[larger[apart]] = 1
            extra[pairs[k:k + (1 << 16)][apart]] = 1
        raw = data.tobytes() if (size > 2).any() else b""
        for g in np.flatnonzero(size > 2).tolist():
            rows = order[bounds[g]:bounds[g + 1]]
            if size[g] > TRIE_MOST:
                inner, number = multikey(data, at[rows] + shallow, length - shallow)
                nth[rows[inner]] = number
                extra[g] = number[-1]
                continue
            members = rows.tolist()
            strings = [raw[p + shallow:p + length] for p in at[rows].tolist()]
            if strings.count(strings[0]) == len(strings):
                continue
            trie = BlindTrie(strings[0], members[0])
            for s, m in zip(strings[1:], members[1:]):
                trie.add(s, m)
            k = 0
            for k, names in enumerate(trie.sorted_names()):
                if k:
                    for m in names:
                        nth[m] = k
            extra[g] = k
    base = np.arange(len(size)) + np.concatenate([[0], np.cumsum(extra)[:-1]])
    out[order] = base[group]
    return out + nth


def _later_strings(table: pa.Table, length: int) -> pa.Table:
    """Ranges of the segments in ``table`` that are covered by strings which start earlier in another."""
    bodies = table.column("body").combine_chunks()
    data, ends = _bytes_of(bodies)
    data = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    starts = np.concatenate([[0], ends[:-1]])
    count = table.column("count").to_numpy()
    seg = np.repeat(np.arange(len(count)), count)
    within = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)
    number = equal_groups(data, starts[seg] + within, length)
    doc, text_hash = table.column("doc"), table.column("text_hash").to_numpy()
    none = doc.is_null().to_numpy()
    ids = doc.fill_null(0).to_numpy()
    start = table.column("start").to_numpy()
    by = np.lexsort((start[seg] + within, text_hash[seg], ids[seg], none[seg], number))
    head = np.ones(len(by), dtype=bool)
    head[1:] = number[by][1:] != number[by][:-1]
    lead = by[np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))]
    same = ((none[seg[by]] == none[seg[lead]]) & (ids[seg[by]] == ids[seg[lead]])
            & (text_hash[seg[by]] == text_hash[seg[lead]])
            & (start[seg[by]] + within[by] == start[seg[lead]] + within[lead]))
    later = np.zeros(len(seg), dtype=bool)
    later[by] = ~same
    # neighbouring strings of a segment make one range
    hit = np.flatnonzero(later)
    opens = np.ones(len(hit), dtype=bool)
    opens[1:] = (hit[1:] != hit[:-1] + 1) | (seg[hit[1:]] != seg[hit[:-1]])
    first = hit[opens]
    last = hit[np.concatenate([opens[1:], [True]])] if len(hit) else hit
    a = start[seg[first]] + within[first]
    b = start[seg[last]] + within[last] + length
    of = pa.array(seg[first])
    return pa.table({"doc": doc.take(of), "text_hash": table.column("text_hash").take(of),
                     "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


# -- the job ------------------------------------------------------------------

def _place() -> Column:
    return F.struct(F.col("doc").isNull().alias("none"), "doc", "text_hash", "start")


def _same_doc(left: str, right: str) -> Column:
    return (F.col(f"{left}.doc").eqNullSafe(F.col(f"{right}.doc"))
            & (F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash")))


def _bodies(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` segments (anchor, doc, text_hash, start, count) with their bytes."""
    lists = wanted.groupBy("doc", "text_hash").agg(
        F.collect_list(F.struct("anchor", "start", "count")).alias("parts"))
    met = (docs.alias("d").join(lists.alias("l"), _same_doc("d", "l"))
           .select("d.doc", "d.text_hash", "d.text", F.explode("l.parts").alias("p")))
    body = F.substring(F.col("text").cast("binary"), F.col("p.start") + 1, F.col("p.count") + (length - 1))
    return met.select("p.anchor", "doc", "text_hash", "p.start", "p.count", body.alias("body"))


def repeated_ranges(docs: DataFrame, length: int, gram: int, max_group: int, bucket_rows: int) -> DataFrame:
    """(doc, text_hash, a, b): byte ranges covered by strings that start earlier elsewhere; they may overlap.

    ``docs`` has doc, text_hash and text.
    """
    shared = written(_segment_rows(docs, length, gram, False).groupBy("anchor").agg(F.count("*").alias("n"))
                      .where("n > 1").select("anchor"), "suffix-anchors")
    found = written(_segment_rows(docs, length, gram, True).join(shared, "anchor", "left_semi"), "suffix-segments")
    distinct = written(found.groupBy("anchor", "content").agg(F.min(_place()).alias("first"),
                                                               F.first("count").alias("count")), "suffix-distinct")
    copies = (found.join(distinct.select("anchor", "content", "first"), ["anchor", "content"])
              .where(~_place().eqNullSafe(F.col("first")))
              .select("doc", "text_hash", F.col("start").alias("a"),
                      (F.col("start") + F.col("count") + (length - 1)).alias("b")))

    several = written(distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "suffix-several")
    rows, most = several.agg(F.sum("kinds"), F.max("kinds")).first()
    buckets = max(1, (rows or 0) // bucket_rows)

    def of(anchors: DataFrame) -> DataFrame:
        left = distinct.join(anchors, "anchor").select("anchor", "first.doc", "first.text_hash", "first.start", "count")
        return _bodies(docs, left, length)

    def search(table: pa.Table) -> pa.Table:
        return _later_strings(table, length)

    sorted_ = (of(several.where(F.col("kinds") <= max_group))
               .withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).groupBy("bucket")
               .applyInArrow(search, "doc long, text_hash long, a long, b long"))
    out = copies.unionByName(sorted_)
    if (most or 0) > max_group:
        crowd = written(of(several.where(F.col("kinds") > max_group)).select(
            "doc", "text_hash", "start", "body", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("k")).select(
            F.md5(F.substring(F.col("body"), F.col("k") + 1, F.lit(length))).alias("string"), "doc", "text_hash",
            (F.col("start") + F.col("k")).alias("start")), "suffix-crowd")
        firsts = written(crowd.groupBy("string").agg(F.min(_place()).alias("first"), F.count("*").alias("n"))
                          .where("n > 1").drop("n"), "suffix-firsts")
        out = out.unionByName(
            crowd.join(firsts, "string").where(~_place().eqNullSafe(F.col("first")))
            .select("doc", "text_hash", F.col("start").alias("a"), (F.col("start") + length).alias("b")))
    return out


SPANS = "array<struct<start:long,end:long>>"


def dedup(docs: DataFrame, length: int = 100, gram: int = 32, id_col: str = "doc_id", text: str = "text",
          max_group: int = 32_768, bucket_rows: int = 16_384) -> DataFrame:
    """``docs`` with ``kept`` (binary: the remaining bytes) and ``removed`` (maximal byte ranges)."""
    if not 8 <= gram <= length < CHUNK:
        raise ValueError("8 <= gram <= length < 1 MiB")
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_of(text)).alias("text_hash"),
                       F.col(text).cast("string").alias("text"))
    gone = (repeated_ranges(base, length, gram, max_group, bucket_rows).groupBy("doc", "text_hash")
            .agg(F.collect_list(F.struct(F.col("a").alias("start"), F.col("b").alias("end"))).alias("__removed"))
            .withColumnsRenamed({"doc": "__doc", "text_hash": "__hash"}))
    types = dict(docs.dtypes)
    if types == {id_col: "bigint", text: "string"}:
        # the texts are dealt out as for the bodies of the segments, so one shuffle serves both joins
        left, back = base, {"doc": id_col, "text": text}
    else:
        left = docs.withColumns({"__of": F.col(id_col).cast("long"), "__th": F.xxhash64(text_of(text))})
        back = {}
    doc, text_hash = ("doc", "text_hash") if back else ("__of", "__th")
    met = (left.join(gone, F.col(doc).eqNullSafe(F.col("__doc")) & (F.col(text_hash) == F.col("__hash")), "left")
           .drop("__doc", "__hash", text_hash, *([] if back else [doc])).withColumnsRenamed(back))
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut_out(batch):
        kept, removed = [], []
        for body, found in zip(batch.column(text).to_pylist(), batch.column("__removed")):
            raw, parts, free, runs = (body or "").encode(), [], 0, []
            if found.is_valid:
                a = found.values.field("start").to_numpy()
                b = found.values.field("end").to_numpy()
                by = np.argsort(a, kind="stable")
                a, b = a[by], np.maximum.accumulate(b[by])
                heads = np.concatenate([[True], a[1:] > b[:-1]])
                tails = np.concatenate([heads[1:], [True]])
                runs = list(zip(a[heads].tolist(), b[tails].tolist()))
            for x, y in runs:
                parts.append(raw[free:x])
                free = y
            kept.append(b"".join([*parts, raw[free:]]))
            removed.append([{"start": x, "end": y} for x, y in runs])
        return {"kept": pa.array(kept, pa.binary()), "removed": pa.array(removed, spans)}
    return map_batches(met, cut_out, f"kept binary, removed {SPANS}", text).drop("__removed")
