"""SimHash near-duplicates, found with a vantage-point tree over fingerprints.

Fingerprint: XXH64 (seed 42) of each word shingle, repeats included; a bit is
set if more than half of the hashes have it.  Two documents are linked when
their fingerprints differ in at most ``max_bits`` bits, and components of
links are the duplicate groups.

The search runs on distinct fingerprints, so exact copies cost nothing more.
A vantage-point tree cuts them into shards: each level has a vantage point and
a radius, a fingerprint goes to the inner or the outer side by its Hamming
distance to the point, and, by the triangle inequality, a pair can be parted
only if its inner member lies within ``max_bits`` of the radius; those members
are sent to the outer shard as well.  Every linked pair thus meets in a shard.
Inside a shard the same tree goes on in memory down to blocks that are
compared in full.  Each shard returns stars that span its components, never
its pairs.

The vantage points and radii are chosen on a bounded sample of fingerprints
(``sample_size``); they steer the cost only.  A shard that stays over
``max_shard`` (a dense ball that no distance can part) is handled exactly
another way: fingerprints within two bits share a fingerprint within one bit of
both, so they are grouped by their 65 neighbours; no such group exceeds 65.

Defined cases: a null or blank text has fingerprint zero and is linked like
any other; fewer words than ``width`` are one shingle; rows are returned one by
one, repeated rows included; a null doc_id joins its component but never names
it; an empty table gives an empty table.  Extra columns are passed through by
``fingerprints``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.batches import importable, map_batches, texts
from ledgerline.llm.common import cut, written
from ledgerline.llm.components import components

SEED = 42
BLOCK = 512


def fingerprint(text: str, width: int) -> int:
    """The 64-bit fingerprint as a signed integer."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    k = min(width, len(words))
    first, last = (end - size)[:len(words) - k + 1].tolist(), end[k - 1:].tolist()
    of = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, dtype=np.int64), len(first)
    for at in range(0, n, 1 << 16):
        h = np.fromiter((of(joined[a:b], SEED) for a, b in zip(first[at:at + (1 << 16)], last[at:at + (1 << 16)])),
                        dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, width: int, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint (long) of ``text``."""
    def run(batch):
        return {out: pa.array([fingerprint(t, width) for t in texts(batch, text)], pa.int64())}
    return map_batches(docs, run, f"`{out}` long", text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# -- the tree -----------------------------------------------------------------

def _bits(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ np.uint64(b)).astype(np.int64)


def plan_tree(sample: np.ndarray, rows: int, shard: int, max_bits: int, tries: int = 24) -> list[tuple[int, int]]:
    """(vantage point, radius) of each level.

    Levels are added until the expected shard holds ``shard`` fingerprints.  A
    level takes, of ``tries`` points and radii near the median, the one that
    leaves the least to compare on the sample as the levels before have split
    it; it ends early where nothing parts the sample any more.
    """
    levels: list[tuple[int, int]] = []
    if not len(sample) or rows <= shard:
        return levels
    points = sample.astype(np.int64)
    leaf = np.zeros(len(points), dtype=np.int64)
    rng = np.random.default_rng(SEED)

    def work(of):
        n = np.unique(of, return_counts=True)[1].astype(float)
        return (n * n).sum()

    scale = rows / len(sample)
    while len(levels) < 62 and work(leaf) / max(len(leaf), 1) * scale > shard:
        best = None
        for v in rng.choice(sample, size=min(tries, len(sample)), replace=False):
            d = _bits(points, np.uint64(np.int64(v).view(np.uint64)))
            middle = int(np.median(d))
            for radius in (middle - 1, middle):
                copies = (d <= radius) & (d > radius - max_bits)
                to = np.concatenate([leaf * 2 + (d > radius), leaf[copies] * 2 + 1])
                if best is None or work(to) < best[0]:
                    best = work(to), int(v), radius, copies, to
        if best[0] > 0.9 * work(leaf):
            break
        levels.append((best[1], best[2]))
        points, leaf = np.concatenate([points, points[best[3]]]), best[4]
        if len(points) > 64 * len(sample):
            break
    return levels


def shards_of(fp: Column, levels: list[tuple[int, int]], max_bits: int) -> Column:
    """The shards a fingerprint is sent to: its own, and those behind a radius it is close to."""
    root = F.array(F.lit(0).cast("long"))
    if not levels:
        return root

    def descend(at, level):
        d, radius = F.bit_count(fp.bitwiseXOR(level["point"])), level["radius"]
        inner, outer = F.transform(at, lambda s: s * 2), F.transform(at, lambda s: s * 2 + 1)
        return (F.when(d > radius, outer)
                .when(d > radius - max_bits, F.concat(inner, outer))
                .otherwise(inner))

    tree = F.array(*[F.struct(F.lit(v).cast("long").alias("point"), F.lit(r).alias("radius")) for v, r in levels])
    return F.aggregate(tree, root, descend)


def _block(fps: np.ndarray, other: np.ndarray, max_bits: int, out: list[np.ndarray]) -> None:
    """Stars that span the components among ``fps`` and ``other``, compared in full."""
    near = np.bitwise_count(fps[:, None] ^ other[None, :]) <= max_bits
    if fps is not other:
        fps, n = np.concatenate([fps, other]), len(fps)
        full = np.zeros((len(fps), len(fps)), dtype=bool)
        full[:n, n:] = near
        full[n:, :n] = near.T
        near = full | np.eye(len(fps), dtype=bool)
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (least == label).all():
            break
        label = least
    star = np.flatnonzero(label != np.arange(len(fps)))
    if len(star):
        out.append(np.stack([fps[star], fps[label[star]]]))


def links_within(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Links (2 x n) that span the components of distinct unsigned fingerprints: a vantage-point tree in memory."""
    out: list[np.ndarray] = []
    todo = [np.unique(fps)]
    while todo:
        part = todo.pop()
        if len(part) <= BLOCK:
            if len(part) > 1:
                _block(part, part, max_bits, out)
            continue
        d = np.bitwise_count(part ^ part[len(part) // 2]).astype(np.int64)
        radius = int(np.median(d))
        if (d > radius).sum() == 0:
            radius -= 1
        inner, outer = part[d <= radius], part[d > radius - max_bits]
        if max(len(inner), len(outer)) <= 0.9 * len(part):
            todo += [inner, outer]
            continue
        cuts = [part[k:k + BLOCK] for k in range(0, len(part), BLOCK)]     # the distance parts too little
        for i, a in enumerate(cuts):
            _block(a, a, max_bits, out)
            for b in cuts[i + 1:]:
                _block(a, b, max_bits, out)
    return np.concatenate(out, axis=1) if out else np.empty((2, 0), dtype=np.uint64)


def find_links(nodes: DataFrame, max_bits: int, shard: int = 2048, max_shard: int = 16384,
               sample_size: int = 4096) -> DataFrame:
    """(a, b): links spanning the components of the distinct fingerprints ``nodes`` (column fp)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2: dense shards are solved by one-bit neighbours")
    importable(nodes.sparkSession)
    rows = nodes.count()
    drawn = nodes.orderBy(F.xxhash64("fp")).limit(sample_size).collect() if rows > shard else []
    levels = plan_tree(np.array([r["fp"] for r in drawn], dtype=np.int64), rows, shard, max_bits)
    sent = nodes.select("fp", F.explode(shards_of(F.col("fp"), levels, max_bits)).alias("shard"))
    dense = sent.groupBy("shard").count().where(F.col("count") > max_shard).select("shard")

    def search(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().astype(np.int64).view(np.uint64)
        a, b = links_within(fps, max_bits).view(np.int64)
        return pa.table({"a": a, "b": b})

    found = (sent.join(dense, "shard", "left_anti").groupBy("shard").applyInArrow(search, "a long, b long"))
    crowd = sent.join(dense, "shard", "left_semi").select("fp").distinct()
    flips = [F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), k)) for k in range(64)]
    if max_bits == 2:
        near = crowd.select("fp", F.explode(F.array(F.col("fp"), *flips)).alias("key"))
        hub = near.groupBy("key").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least != most")
        crossed = near.join(hub, "key").where("fp != least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    else:
        near = crowd.select("fp", F.explode(F.array(*flips)).alias("key"))
        crossed = (near.join(crowd.select(F.col("fp").alias("key")), "key").where(F.lit(max_bits == 1))
                   .select(F.col("fp").alias("a"), F.col("key").alias("b")))
    return found.unionByName(crossed).distinct()


def near_duplicates(docs: DataFrame, width: int, max_bits: int = 2, id_col: str = "doc_id", text: str = "text",
                    **search) -> DataFrame:
    """(id, text_hash, fingerprint, component_id) for every row of ``docs``; component_id is the least id."""
    fps = cut(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), width)
              .select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("fingerprint").alias("fp")))
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(find_links(nodes.select("fp"), max_bits, **search)).withColumnRenamed("node", "fp")
    grouped = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # written tables: each side of the joins then has a shuffle of its own, and a hot group or fingerprint can be split
    names = written(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-names")
    named = written(grouped.join(names, "root").select("fp", "root", "component_id"), "simhash-groups")
    return fps.join(named, "fp").select(F.col("doc_id").alias(id_col), "text_hash", F.col("fp").alias("fingerprint"),
                                        "component_id", F.col("root").alias("__root"))


def keep_first(docs: DataFrame, width: int, max_bits: int = 2, id_col: str = "doc_id", text: str = "text",
               **search) -> DataFrame:
    """``docs`` with one document of each group: the one of least id (rows without an id come last).

    Of rows with the same id in a group the one of least text hash stays, and
    of fully repeated rows one.
    """
    found = near_duplicates(docs, width, max_bits, id_col, text, **search)
    one = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("text_hash").alias("hash"))
    least = found.groupBy("__root").agg(F.min(one).alias("one"))
    rows = found.groupBy("__root", id_col, "text_hash").agg(F.count("*").alias("n")).alias("r")
    kept = cut(rows.join(least, "__root").where(one.eqNullSafe(F.col("one")))
               .select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"), (F.col("n") > 1).alias("many")))

    def rows_of(many: bool) -> DataFrame:
        return docs.join(kept.where(F.col("many") == many).drop("many"),
                         F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left_semi")
    repeated = (rows_of(True).withColumns({"__key": F.col(id_col), "__text": F.xxhash64(text)})
                .dropDuplicates(["__key", "__text"]).drop("__key", "__text"))
    return rows_of(False).unionByName(repeated)
