"""Product codes against integers of plain Python."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import vector_codes as q

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts, entries, rounds, scale):
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vec = [[math.floor(scale * x) for x in r[1]] for r in rows]
    w = len(vec[0]) // parts
    cut = [[v[p * w:p * w + w] for p in range(parts)] for v in vec]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign(c):
        out = []
        for p in range(parts):
            gaps = [sum((a - b) ** 2 for a, b in zip(c[p], e)) for e in books[p]]
            out.append((gaps.index(min(gaps)), min(gaps)))
        return out
    for _ in range(rounds):
        groups = defaultdict(list)
        for c in cut:
            for p, (e, _) in enumerate(assign(c)):
                groups[p, e].append(c[p])
        for (p, e), g in groups.items():
            books[p][e] = [sum(x) // len(g) for x in zip(*g)]
    found = [assign(c) for c in cut]
    error = [sum(g for _, g in a) for a in found]
    by_label = defaultdict(int)
    for r, e in zip(rows, error):
        by_label[r[2]] += e
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted((r[0] is None, r[0] or 0, [e for e, _ in a], s, by_label[r[2]]) for r, a, s in zip(rows, found, error)), sha


def result(df):
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["codes"], r["error"], r["label_error"]) for r in df.collect())


@pytest.mark.parametrize("spread, parts, entries, rounds", [(1, 4, 8, 2), (0.02, 2, 8, 3), (8e4, 4, 5, 1), (3, 8, 100, 2)])
def test_random_vectors(spark, spread, parts, entries, rounds):
    rng = np.random.default_rng(int(spread * 100))
    rows = [(int(k), [float(np.float32(x)) for x in rng.normal(0, spread, 8)], int(k) % 3 or None)
            for k in rng.permutation(90)]
    rows += [(200, rows[0][1], 1), (201, rows[0][1], None), (202, None, 1), (203, [1.0] * 7 + [None], 2),
             (204, [float("nan")] * 8, 1), (205, [float("-inf")] + [0.0] * 7, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("error", F.lit("own"))
    got, books = q.compress(df, parts=parts, entries=entries, rounds=rounds)
    want, sha = brute(rows, parts, entries, rounds, 256)
    assert result(got) == want and q.digest(books) == sha


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for bound in (3, 1 << 20, q.LARGEST - 1):
        a, b = (rng.integers(-bound, bound + 1, (40, 24)) for _ in range(2))
        a[0], b[0] = bound, -bound
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert q.exact_products(a, b).tolist() == want
        parts = q.limbs(a, 11, bound)
        assert all(np.abs(p).max() <= 1 << 11 for p in parts)
        assert (sum(p.astype(np.int64) << (11 * k) for k, p in enumerate(parts)) == a).all()


def test_odd_rows(spark):
    rows = [(None, [0.5, -0.5], None), (3, [0.25, 0.0], 1), (3, [-0.25, 0.0], 1), (7, [0.25, 0.0], None), (8, [], 1),
            (9, [1.0, 2.0, 3.0], 1), (None, None, None)]
    got, books = q.compress(spark.createDataFrame(rows, SCHEMA), parts=2, entries=3)
    kept = [r for r in rows if r[1] and len(r[1]) == 2]
    want, sha = brute(kept, 2, 3, 2, 256)
    assert result(got) == want and q.digest(books) == sha and len(want) == 4
    for none in (rows[-1:], []):
        empty, books = q.compress(spark.createDataFrame(none, SCHEMA))
        assert empty.count() == 0 and books.shape == (16, 0, 0) and "label_error" in empty.columns
    with pytest.raises(ValueError):
        q.compress(spark.createDataFrame([(1, [1.0] * 3, 1)], SCHEMA), parts=2)
    with pytest.raises(Exception, match="beyond"):
        q.compress(spark.createDataFrame([(1, [1e30, 1.0], 1)], SCHEMA), parts=2)
