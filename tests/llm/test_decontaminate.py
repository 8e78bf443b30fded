import re

import pytest

from ledgerline.llm import decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEM = "item_id long, text string"


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items, width=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(width, len(b))
        wins = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "Short item HERE"), (3, None),
         (4, ""), (10, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (None, "line two"), (2, "short item here"),
         (5, "one1 é漢 x")]
TEXTS = ["so alpha, beta gamma\ndelta epsilon zeta ETA theta iota kappa. lambda mu nu", "a short-item HERE short item here",
         "line two", "alpha beta gamma", "ONE1 É漢 x one1 é漢 x", "", "short item"]


@pytest.mark.parametrize("max_words", [10**6, 5])
def test_hits(spark, odd, none, max_words):
    docs = odd.select("doc_id", "text", "source").unionByName(
        spark.createDataFrame([(100 + k, t, "s") for k, t in enumerate(TEXTS)], none.schema))
    bench = spark.createDataFrame(ITEMS, ITEM)
    for r in d.find_leaks(docs, bench, max_words=max_words).collect():
        hit = sum(x["end"] - x["start"] for x in r["hit_ranges"])
        assert (r["n_words"], hit, r["hit_items"]) == brute(r["text"], ITEMS), (r["text"] or "")[:60]


def test_drop_and_cut(spark, odd, none):
    bench = spark.createDataFrame(ITEMS, ITEM)
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(TEXTS)], none.schema)
    assert [r["doc_id"] for r in d.decontaminate(docs, bench).orderBy("doc_id").collect()] == [3, 5, 6]
    cut = {r["doc_id"]: r["text"] for r in d.decontaminate(docs, bench, mode="cut").collect()}
    assert cut[0] == "so  nu" and cut[1] == "a " and cut[3] == TEXTS[3] and cut[4] == "ONE1 É漢 x "
    assert d.decontaminate(odd, bench).columns == odd.columns
    assert d.decontaminate(odd, bench.limit(0)).count() == odd.count()
    assert d.decontaminate(none, bench, mode="cut").count() == 0
    with pytest.raises(ValueError):
        d.decontaminate(docs, bench, mode="other")


def test_one_shard_is_broadcast_at_a_time(spark, none, monkeypatch):
    from pyspark import SparkContext
    live, most = [], []

    def broadcast(self, value, own=SparkContext.broadcast):
        b = own(self, value)
        live.append(b)
        most.append(len(live))
        destroy = b.destroy
        b.destroy = lambda *a: (live.remove(b), destroy(*a))
        return b
    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(TEXTS)], none.schema)
    found = d.find_leaks(docs, spark.createDataFrame(ITEMS, ITEM), max_words=5)
    assert len(most) > 4 and max(most) == 1
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    for r in found.collect():
        assert r["hit_items"] == brute(r["text"], ITEMS)[2]
