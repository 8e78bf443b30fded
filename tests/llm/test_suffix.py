import random

import numpy as np
import pytest

from ledgerline.llm import suffix_dedup as q


def brute(rows, length):
    """rows: (doc key, bytes) in order; the kept bytes of each."""
    seen, out = set(), {}
    for key, raw in rows:
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            if s in seen:
                gone[i:i + length] = True
            seen.add(s)
        out[key] = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes(), int((np.diff(np.r_[0, gone]) == 1).sum())
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(40, 400))) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.6 else
                 "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 200))) for _ in range(rng.randint(0, 6))]
        texts.append("".join(parts))
    return texts + ["z" * 700, "z" * 250, "ab" * 300, "".join(passages), "".join(passages)]


@pytest.mark.parametrize("options", [{}, {"max_group": 1}, {"bucket_rows": 3}, {"gram": 8}, {"length": 16, "gram": 8},
                                     {"length": 64, "gram": 64, "max_group": 2}])
def test_random_corpus(spark, none, options):
    length = options.get("length", 100)
    texts = corpus(11)
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], none.schema).repartition(5)
    want = brute([(k, t.encode()) for k, t in enumerate(texts)], length)
    for r in q.dedup(docs, **options).collect():
        assert (bytes(r["kept"]), len(r["removed"])) == want[r["doc_id"]]


def test_chunks_do_not_change_the_result(spark, none, monkeypatch):
    data = "".join(corpus(3)).encode()
    ends = np.cumsum([len(t.encode()) for t in corpus(3)])
    strings = lambda: sorted(int(p) + k for place, count, _, _ in q.segments(np.frombuffer(data, np.uint8), ends, 100, 32)  # noqa: E731,E501
                             for p, c in zip(place, count) for k in range(c))
    whole = strings()
    monkeypatch.setattr(q, "CHUNK", 257)
    q._powers.cache_clear()
    assert strings() == whole
    q._powers.cache_clear()
    starts = np.r_[0, ends[:-1]]
    assert whole == [i for a, b in zip(starts, ends) for i in range(a, b - 99)]


def test_equal_groups_sorts(monkeypatch):
    rng = random.Random(1)
    raw = "".join(rng.choice("ab") for _ in range(3000)).encode() * 2
    data = np.concatenate([np.frombuffer(raw, np.uint8), np.zeros(8, np.uint8)])
    at = np.arange(len(raw) - 40)
    for shallow, most in ((8, 2048), (16, 2048), (20, 2048), (40, 2048), (8, 3), (12, 3)):
        monkeypatch.setattr(q, "TRIE_MOST", most)
        got = q.equal_groups(data, at, 40, shallow)
        strings = sorted({raw[p:p + 40] for p in at})
        number = {s: k for k, s in enumerate(strings)}
        assert [number[raw[p:p + 40]] for p in at] == got.tolist()


def test_odd_rows(spark, odd, none):
    rows = {}
    for r in q.dedup(odd).collect():
        rows.setdefault((r["doc_id"], r["text"]), set()).add(bytes(r["kept"]))
    assert all(len(v) == 1 for v in rows.values())              # repeated rows get one result
    assert rows[(4, "One word.")] == {b"One word."} and rows[(1, None)] == {b""}
    want = brute([(k, (t or "").encode()) for k, t in sorted(
        ((k, t) for k, t in rows if k in (6, 7, 10)), key=lambda x: x[0])], 100)
    assert all(rows[(k, t)] == {want[k][0]} for k, t in rows if k in (6, 7, 10))
    assert q.dedup(none).count() == 0


def test_texts_of_one_id_are_told_apart(spark, none):
    from pyspark.sql import functions as F
    shared = "the shared passage " * 8
    quoting, own = f"{shared}36523", " ".join(f"own{k}" for k in range(40)) + " 204831"
    docs = spark.createDataFrame([(1, shared, "s"), (None, quoting, "s"), (None, own, "s")], none.schema)
    hashes = docs.where("doc_id IS NULL").select(F.hash("text"))
    assert hashes.distinct().count() == 1          # equal by 32 bits
    got = {r["text"]: bytes(r["kept"]).decode() for r in q.dedup(docs).collect()}
    assert got[own] == own and len(got[quoting]) < 100
