import numpy as np
import pytest
import xxhash

from ledgerline.llm import simhash as q


def brute_print(text, width=3):
    w = text.encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits=2):
    v = np.array(prints, dtype=np.uint64)
    label = np.arange(len(v))
    near = [np.flatnonzero(np.bitwise_count(v ^ x) <= bits) for x in v]
    while True:
        least = np.array([label[n].min() for n in near])
        if (least == label).all():
            return label
        label = least


def test_fingerprints(odd, none):
    for r in q.fingerprints(odd, 3).collect():
        if len(r["text"] or "") < 10_000:
            assert r["fingerprint"] & (2**64 - 1) == brute_print(r["text"] or "")
    assert q.fingerprints(none, 3).count() == 0


def cloud(seed, n, centers, spread):
    rng = np.random.default_rng(seed)
    c = rng.integers(0, 2**63, centers, dtype=np.int64).view(np.uint64)
    v = c[rng.integers(0, centers, n)]
    for _ in range(spread):
        v = v ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(v)


@pytest.mark.parametrize("centers, spread", [(3000, 1), (3, 3), (40, 4), (1, 2)])
def test_links_within_span_the_groups(centers, spread):
    v = cloud(centers, 3000, centers, spread)
    a, b = q.links_within(v, 2)
    assert (np.bitwise_count(a ^ b) <= 64).all()
    place = {x: i for i, x in enumerate(v.tolist())}
    label = list(range(len(v)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for x, y in zip(a.tolist(), b.tolist()):
        i, j = sorted((root(place[x]), root(place[y])))
        label[j] = i
    assert [root(i) for i in range(len(v))] == brute_groups(v).tolist()


@pytest.mark.parametrize("options", [{}, {"shard": 64}, {"shard": 64, "max_shard": 100}, {"shard": 1, "max_shard": 1}])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_find_links_over_shards(spark, options, bits):
    from ledgerline.llm.components import components
    v = np.concatenate([cloud(5, 600, 600, 1), cloud(6, 500, 2, 3)])
    v = np.unique(v)
    nodes = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    got = {r["node"]: r["root"] for r in components(q.find_links(nodes, bits, **options)).collect()}
    want = brute_groups(v, bits)
    signed = v.view(np.int64).tolist()
    mine = [got.get(x, x) for x in signed]
    same = {}
    assert all(same.setdefault(w, m) == m for w, m in zip(want.tolist(), mine))
    assert len(set(mine)) == len(set(want.tolist()))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(q.near_duplicates(docs, 3).collect(), key=lambda r: r["doc_id"])
    label = brute_groups([r["fingerprint"] & (2**64 - 1) for r in rows])
    assert [r["component_id"] for r in rows] == [rows[k]["doc_id"] for k in label]
    kept = sorted(r["doc_id"] for r in q.keep_first(docs, 3).collect())
    assert kept == sorted({r["component_id"] for r in rows})


def test_odd_rows(odd, none):
    rows = q.near_duplicates(odd, 3).collect()
    assert len(rows) == odd.count()
    zero = {r["component_id"] for r in rows if r["fingerprint"] == 0}
    assert zero == {1}                      # null and blank texts, one of them without an id
    kept = q.keep_first(odd, 3)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(4) == 1 and ids.count(1) == 1 and 2 not in ids and ids.count(None) == 1 and ids.count(5) == 2
    assert q.keep_first(none, 3).count() == 0 and q.near_duplicates(none, 3).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    from ledgerline.llm.components import components
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(501, 700)]
    links = spark.createDataFrame(path + star + [(7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 500 for k in range(500, 700))
    assert components(links.limit(0)).count() == 0
