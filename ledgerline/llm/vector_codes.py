"""Product codes of vectors: integer k-means per part, by limb-split exact matrix products.

Every component x becomes the integer floor(scale * x) and a vector is cut
into ``parts`` equal consecutive parts.  Each part has a codebook of at most
``entries`` integer centres.  A part goes to the centre of least squared
distance, ties to the lower index; ``rounds`` times the centres are replaced
by the floored means of their parts, and unused centres stay.

Distances are exact.  Integers are broken into limbs so small that a matrix
product of two limbs, summed over a part, stays below 2^53 and float64 BLAS
gives it without rounding; the limb products are shifted and added up in
int64.  The distance to a centre is then |x|^2 - 2 x.c + |c|^2, and the first
argmin decides.

Every round is one pass over the vectors.  A task adds up sums and counts of
its parts and hands out one row per used centre, so the driver receives the
sums over all tasks: ``parts`` * ``entries`` rows, whatever the table's size.
The codebooks, as small, travel with the next pass.

Defined cases: a vector that is null, or holds a null or non-finite
component, is dropped, and so is one whose length is not the commonest among
the others (ties: the longest).  The commonest length must be a multiple of
``parts``.  Rows of equal id start in the order of their vectors; a row
without an id comes after all others.  Fewer than ``entries`` vectors give
fewer centres; none give an empty table.  Integers beyond 2^27 raise, since
squared distances could leave int64.  Extra columns are passed through;
those called like an output are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.batches import importable, map_batches, slices
from ledgerline.llm.common import written

LARGEST = 1 << 27
INF = float("inf")


def limbs(x: np.ndarray, width: int, bound: int) -> list[np.ndarray]:
    """Float64 limbs of integers up to ``bound`` in size: x = sum of limb_k * 2^(width * k); the top one has the sign."""
    out = []
    while bound >= 1 << width:
        out.append((x & ((1 << width) - 1)).astype(np.float64))
        x, bound = x >> width, (bound >> width) + 1
    return out + [x.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact as long as the result fits int64."""
    # the sum of ``length`` products of two limbs of ``width`` bits stays below 2^53
    width = (52 - math.ceil(math.log2(max(a.shape[1], 2)))) // 2
    left, right = (limbs(m, width, int(np.abs(m).max(initial=0)) + 1) for m in (a, b))
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (width * (i + j))
    return out


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First nearest centre of each row of ``parts`` and its squared distance."""
    gap = (book * book).sum(axis=1) - 2 * exact_products(parts, book)
    at = gap.argmin(axis=1)
    return at, gap[np.arange(len(parts)), at] + (parts * parts).sum(axis=1)


def integers(batch: pa.RecordBatch, column: str, scale: int) -> np.ndarray:
    """The floored integers of the vectors of a batch, one row each."""
    flat = pc.list_flatten(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat * scale)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError("a scaled component is beyond 2^27")
    return scaled.astype(np.int64).reshape(batch.num_rows, -1)


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is whole, finite and of the commonest length."""
    c = F.col(column)

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(INF))
    whole = vectors.where(c.isNotNull() & F.forall(c, finite))
    most = whole.groupBy(F.size(c).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return whole.where(F.size(c) == (most["n"] if most else 0))


def first_books(kept: DataFrame, column: str, id_col: str, parts: int, entries: int, scale: int) -> np.ndarray:
    """(part, entry, position): the parts of the vectors of least ids."""
    rows = (kept.select(F.col(id_col).alias("id"), F.col(column).alias("v"))
            .orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect())
    if not rows:
        return np.zeros((parts, 0, 0), dtype=np.int64)
    if not len(rows[0]["v"]) or len(rows[0]["v"]) % parts:
        raise ValueError(f"vectors of {len(rows[0]['v'])} components do not make {parts} equal parts")
    batch = pa.RecordBatch.from_pydict({"v": pa.array([r["v"] for r in rows], pa.list_(pa.float64()))})
    return np.ascontiguousarray(integers(batch, "v", scale).reshape(len(rows), parts, -1).transpose(1, 0, 2))


def next_books(kept: DataFrame, column: str, books: np.ndarray, scale: int) -> np.ndarray:
    """The codebooks after one round over all vectors."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)          # the last position counts
        for whole in batches:
            for batch in slices(whole, column, 1 << 16):
                x = integers(batch, column, scale).reshape(batch.num_rows, parts, width)
                for p in range(parts):
                    at, _ = nearest(x[:, p], books[p])
                    order = np.argsort(at, kind="stable")
                    used, start = np.unique(at[order], return_index=True)
                    total[p, used, :width] += np.add.reduceat(x[order, p], start, axis=0)
                    total[p, used, width] += np.diff(np.append(start, len(at)))
        p, e, k = (m.ravel() for m in np.indices(total.shape))
        live = (total[:, :, width] > 0)[p, e]
        yield pa.RecordBatch.from_pydict({"part": pa.array(p[live], pa.int32()), "entry": pa.array(e[live], pa.int32()),
                                          "pos": pa.array(k[live], pa.int32()), "total": total.ravel()[live]})

    rows = (kept.select(column).mapInArrow(sums, "part int, entry int, pos int, total long")
            .groupBy("part", "entry", "pos").agg(F.sum("total").alias("total")).collect())
    total = np.zeros((parts, entries, width + 1), dtype=np.int64)
    for r in rows:                                                # at most parts * entries * (width + 1) of them
        total[r["part"], r["entry"], r["pos"]] = r["total"]
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)


def codebooks(kept: DataFrame, column: str = "embedding", id_col: str = "vec_id", parts: int = 16, entries: int = 64,
              rounds: int = 2, scale: int = 256) -> np.ndarray:
    """Trained codebooks (part, entry, position) of the usable vectors ``kept``."""
    importable(kept.sparkSession)
    books = first_books(kept, column, id_col, parts, entries, scale)
    for _ in range(rounds if books.size else 0):
        books = next_books(kept, column, books, scale)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all centres' decimal components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(kept: DataFrame, books: np.ndarray, column: str = "embedding", scale: int = 256) -> DataFrame:
    """``kept`` with ``codes`` (array of centre indexes, one per part) and ``error`` (squared distances, summed)."""
    parts, _, width = books.shape

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        x = integers(batch, column, scale).reshape(batch.num_rows, parts, width)
        found = [nearest(x[:, p], books[p]) for p in range(parts)]
        codes = np.stack([at for at, _ in found], axis=1).astype(np.int32)
        offsets = pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32))
        return {"codes": pa.ListArray.from_arrays(offsets, pa.array(codes.ravel())),
                "error": pa.array(sum(gap for _, gap in found))}
    return map_batches(kept, run, "codes array<int>, error long", column)


def compress(vectors: DataFrame, column: str = "embedding", id_col: str = "vec_id", label: str = "label",
             parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, np.ndarray]:
    """(usable rows with codes, error and label_error; codebooks).

    ``label_error`` is the error summed over the rows of equal label, nulls
    together: partial sums per label, joined back from a written table.
    """
    kept = usable(vectors, column)
    books = codebooks(kept, column, id_col, parts, entries, rounds, scale)
    if not books.size:
        none = kept.withColumns({"codes": F.lit(None).cast("array<int>"), "error": F.lit(None).cast("long"),
                                 "label_error": F.lit(None).cast("long")})
        return none.limit(0), books
    coded = encode(kept, books, column, scale)
    coded = coded.drop(*[c for c in coded.columns if c.lower() == "label_error" and c != label])
    totals = written(coded.groupBy(F.col(label).alias("__label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(totals, F.col(label).eqNullSafe(F.col("__label"))).drop("__label"), books


def as_hex(codes: Column) -> Column:
    """Codes as two lowercase hex digits each (up to 256 centres)."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
