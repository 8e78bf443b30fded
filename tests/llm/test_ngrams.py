"""The Jaccard join against comparison of all pairs."""

import random

import numpy as np
import pytest

from ledgerline.llm import ngram_join as q


def shingles(text, width):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(sets, percent):
    """Least place reachable by links."""
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    holders = {}
    for i, s in enumerate(sets):
        for other in set().union(*(holders.get(g, ()) for g in s)) if s else ():
            both = len(s & sets[other])
            if 100 * both >= percent * (len(s) + len(sets[other]) - both):
                a, b = sorted((root(i), root(other)))
                label[b] = a
        for g in s:
            holders.setdefault(g, []).append(i)
    return [root(i) for i in range(len(sets))]


def families(seed, n, sizes, edits, universe=1 << 40):
    """Random sets in families whose members differ in some n-grams."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = rng.sample(range(universe), rng.choice(sizes))
        for _ in range(rng.randint(1, 6)):
            s = set(base)
            for _ in range(rng.randint(0, edits)):
                s.discard(rng.choice(base))
                s.add(rng.randrange(universe))
            out.append(frozenset(s))
    return sorted(set(out), key=sorted)


def arrays(sets):
    return [np.array(sorted(s), dtype=np.uint64) for s in sets]


@pytest.mark.parametrize("percent", [90, 80, 55, 100])
@pytest.mark.parametrize("sizes, edits, universe", [([1, 2, 3, 8, 9, 10, 11, 20], 2, 1 << 40), ([60, 66], 4, 1 << 40),
                                                    ([300], 20, 1 << 40), ([8, 9, 10], 3, 14)])
def test_tree_and_keys(percent, sizes, edits, universe):
    sets = families(percent, 60, sizes, edits, universe)
    want = brute(sets, percent)
    for states in (1, 300, 1 << 17):
        zero = np.zeros(len(sets), dtype=np.int64)
        got = q.PrefixTree(arrays(sets), zero, np.arange(len(sets)), percent).join(states)
        same = {}
        assert all(same.setdefault(w, g) == g for w, g in zip(want, got)) and len(set(got)) == len(set(want))
    owner, key = q.part_keys(arrays(sets), percent)
    keys = {}
    for i, k in zip(owner.tolist(), key.tolist()):
        keys.setdefault(i, set()).add(k)
    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                assert keys[i] & keys[j]


def test_trees_of_several_components_and_known_labels():
    sets = families(4, 30, [40], 3)
    comp = np.arange(len(sets)) % 3
    got = q.PrefixTree(arrays(sets), comp, np.arange(len(sets)), 80).join(100)
    for c in range(3):
        mine = np.flatnonzero(comp == c)
        want = brute([sets[i] for i in mine], 80)
        assert len(set(zip(want, got[mine]))) == len(set(want)) == len(set(got[mine]))
    label = np.zeros(len(sets), dtype=np.int64)
    assert set(q.PrefixTree(arrays(sets), label, label, 80).join(100)) == {0}


def corpus(seed, n):
    """Texts in families of near copies, with passages that many of them share."""
    rng = random.Random(seed)
    passage = [f"shared{k}" for k in range(40)]
    texts = []
    for f in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([2, 5, 12, 60, 150]))]
        if f % 3 == 0:
            words = words[:8] + passage + words[8:]
        for _ in range(rng.randint(1, 7)):
            w = list(words)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10_000)}"
            texts.append(rng.choice([" ", "\n", "  "]).join(w))
    return texts + texts[:9] + [t.upper() for t in texts[:5]]


@pytest.mark.parametrize("options", [{}, {"budget": 1200}])
def test_documents_in_one_task_and_in_rounds(spark, none, options):
    texts = corpus(2, 30)
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], none.schema).repartition(4)
    sets = [shingles(t, 3) for t in texts]
    want = brute(sets, 80)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in q.join(docs, 3, 80, **options).collect()}
    assert got == {k: (len(s), w) for k, (s, w) in enumerate(zip(sets, want))}


def test_given_documents(spark):
    rows = sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for width, percent in ((3, 90), (5, 80)):
        sets = [shingles(r["text"], width) for r in rows]
        want = brute(sets, percent)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in q.join(docs, width, percent).collect()}
        assert got == {r["doc_id"]: (len(s), rows[w]["doc_id"]) for r, s, w in zip(rows, sets, want)}


def test_odd_rows(spark, odd, none):
    rows = q.join(odd, 3, 90).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[4] == [(1, 4)] * 2 and by[7] == [(1, 7)]
    assert sorted(by[None], key=str) == [(0, None), (1, None)] and len(by[5]) == 2
    assert by[6] == [(1, 6)]
    assert q.join(none, 3, 90).count() == 0 and q.join(odd.where("text is null"), 3, 90).count() == 2
    with pytest.raises(ValueError):
        q.join(odd, 3, 0)
