"""Exactness of the fuzzy candidate join and of the balanced window steps,
each against a brute-force computation on small data."""

import hashlib
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import match, windows


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def brute_pairs(left, right, t):
    out = set()
    for lk, lb, ln in left:
        for rk, rb, rn in right:
            if lb is None or rb is None or lb.strip() == "" or lb != rb or not ln or rn is None:
                continue
            if 1.0 - lev(ln, rn) / len(ln) >= t:
                out.add((lk, rk))
    return out


def spark_pairs(spark, left, right, t):
    L = spark.createDataFrame(left, "k string, b string, n string")
    R = spark.createDataFrame(right, "k string, b string, n string")
    res = match.similar_pairs(L, R, "k", "k", "n", "n", "b", "b", t)
    return {(r._lk, r._rk) for r in res.collect()}


names = st.text(alphabet="abcab#01", min_size=0, max_size=12)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "", None]), names), min_size=1, max_size=12),
       st.lists(st.tuples(st.sampled_from(["x", "y", " "]), names), min_size=1, max_size=12),
       st.sampled_from([0.5, 0.7, 0.8, 0.9]))
def test_similar_pairs_equals_brute_force(spark, lefts, rights, t):
    left = [(f"L{i}", b, n) for i, (b, n) in enumerate(lefts)]
    right = [(f"R{i}", b, n) for i, (b, n) in enumerate(rights)]
    assert spark_pairs(spark, left, right, t) == brute_pairs(left, right, t)


def test_similar_pairs_realistic_names(spark):
    rnd = random.Random(7)
    base = ["Acme Holdings", "Globex Corp", "Initech LLC", "Umbrella plc", "Stark Industries"]
    left, right = [], []
    for i in range(60):
        b = rnd.choice(base)
        s = list(b)
        for _ in range(rnd.randint(0, 3)):
            op = rnd.randint(0, 2)
            p = rnd.randrange(len(s))
            if op == 0:
                s[p] = rnd.choice("xyz")
            elif op == 1:
                del s[p]
            else:
                s.insert(p, "q")
        left.append((f"L{i}", "T1" if i % 2 else "T2", "".join(s)))
        right.append((f"R{i}", "T1" if i % 3 else "T2", b))
    assert spark_pairs(spark, left, right, 0.8) == brute_pairs(left, right, 0.8)


def test_match_pipeline_routes_once(spark):
    main = spark.createDataFrame([("m1", "Acme Holdings", "T1", "a", "1"), ("m2", "Globex Corp", "T2", "b", "2")],
                                 "business_entity_id string, name string, tax_id string, address string, postal_code string")
    src = spark.createDataFrame([("m1", "Acme Holdings", "T1", "a", "1"),       # known key
                                 ("n1", "Acme Holding", "T1", "a", "1"),        # one edit → matched
                                 ("n2", "Acme Holdings", "T9", "a", "1"),       # other tax id → insert
                                 ("n3", "Glbx", "T2", "b", "2"),                # too far → insert
                                 ("n4", "Acme Holdings", "", "a", "1")],        # blank tax id never matches
                                "business_entity_id string, name string, tax_id string, address string, postal_code string")
    routed = {r.business_entity_id: (r.route, r.target_key) for r in match.deduplicate(src, main).collect()}
    assert routed == {"m1": ("update_known", "m1"), "n1": ("update_matched", "m1"), "n2": ("insert", None),
                      "n3": ("insert", None), "n4": ("insert", None)}


def test_match_plan_has_no_cartesian(spark):
    p = spark.createDataFrame([("1", "abc", "T", "a", "1")],
                              "business_entity_id string, name string, tax_id string, address string, postal_code string")
    plan = match.match_scores(p, p)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _events(n_hot=400, n_other=60, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_hot):
        rows.append((i, 1, rnd.randint(0, 10_000), rnd.randint(-5, 9), rnd.choice("abc")))
    for i in range(n_hot, n_hot + n_other):
        rows.append((i, rnd.randint(2, 5), rnd.randint(0, 10_000), rnd.randint(-5, 9), rnd.choice("abc")))
    return rows


def test_running_sum_hot_key_matches_pandas(spark):
    rows = _events()
    df = spark.createDataFrame(rows, "id long, k long, t long, v long, s string")
    out = windows.running_sum(df, ["k"], ["t", "id"], "v", "run", chunks=6).toPandas()
    pdf = pd.DataFrame(rows, columns=["id", "k", "t", "v", "s"]).sort_values(["k", "t", "id"])
    pdf["run"] = pdf.groupby("k")["v"].cumsum()
    got = dict(zip(out["id"], out["run"]))
    assert got == dict(zip(pdf["id"], pdf["run"]))


def test_running_sum_global(spark):
    rows = _events(50, 50)
    df = spark.createDataFrame(rows, "id long, k long, t long, v long, s string")
    out = windows.running_sum(df, [], ["t", "id"], "v", "run", chunks=5).toPandas()
    pdf = pd.DataFrame(rows, columns=["id", "k", "t", "v", "s"]).sort_values(["t", "id"])
    pdf["run"] = pdf["v"].cumsum()
    assert dict(zip(out["id"], out["run"])) == dict(zip(pdf["id"], pdf["run"]))


def test_previous_value_hot_key(spark):
    rows = _events()
    df = spark.createDataFrame(rows, "id long, k long, t long, v long, s string")
    out = windows.previous_value(df, ["k"], ["t", "id"], "s", "prev", chunks=7).toPandas()
    pdf = pd.DataFrame(rows, columns=["id", "k", "t", "v", "s"]).sort_values(["k", "t", "id"])
    pdf["prev"] = pdf.groupby("k")["s"].shift(1)
    want = {i: (None if pd.isna(p) else p) for i, p in zip(pdf["id"], pdf["prev"])}
    got = {i: (None if p is None or (isinstance(p, float) and pd.isna(p)) else p) for i, p in zip(out["id"], out["prev"])}
    assert got == want


def test_latest_is_partial_aggregate(spark):
    from ledgerline.operators.dedupe import latest
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    out = latest(df, ["k"], ["t"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") + plan.count("ObjectHashAggregate") >= 2
    assert sorted(tuple(r) for r in out.collect()) == [(0, 99, 99), (1, 97, 97), (2, 98, 98)]


def test_profile_keeps_every_address_and_scores_count_any(spark):
    details = spark.createDataFrame([("e1", "Acme Trading"), ("e2", "Acme Tradinq")],
                                    "business_entity_id string, business_entity_name string")
    ids = spark.createDataFrame([("e1", "tax_id", "9"), ("e2", "tax_id", "9"), ("e1", "dba", "x")],
                                "related_identifier string, identifier_type string, identifier_value string")
    addr = spark.createDataFrame([("e1", "Dock 1", "P1"), ("e1", "Dock 2", "P2"), ("e2", "Dock 2", "P2")],
                                 "related_identifier string, street_line_1 string, postal_code string")
    prof = match.match_profile(details, ids, addr)
    assert sorted((r.business_entity_id, r.address) for r in prof.collect()) == [
        ("e1", "Dock 1"), ("e1", "Dock 2"), ("e2", "Dock 2")]
    scores = match.match_scores(prof, prof).filter("src_business_entity_id <> main_business_entity_id").collect()
    assert sorted((r.src_business_entity_id, r.main_business_entity_id, r.address_score) for r in scores) == [
        ("e1", "e2", 1.0), ("e2", "e1", 1.0)]               # one row per pair, whatever the addresses


def test_candidates_are_not_deduplicated(spark):
    """Names full of repeated segments meet at many of them and are still emitted once, without a distinct of pairs."""
    df = spark.createDataFrame([(i, "t", "ab" * 9 + str(i)) for i in range(6)], "k int, b string, name string")
    pairs = match.similar_pairs(df, df, "k", "k", "name", "name", "b", "b", 0.8)
    rows = [(r._lk, r._rk) for r in pairs.collect()]
    assert len(rows) == len(set(rows)) == 36


def test_a_shared_prefix_makes_no_candidates(spark):
    """Names of one prefix in one block: rare segments lead to few pairs that do not pass."""
    names = [(k, f"Customer#{k:09d} of {hashlib.md5(str(k).encode()).hexdigest()[:16]}", "T") for k in range(400)]
    main = spark.createDataFrame(names, "k int, name string, tax string")
    src = main.withColumn("name", F.concat(F.substring("name", 1, 24), F.lit("~"), F.substring("name", 26, 20)))
    args = ("k", "k", "name", "name", "tax", "tax", 0.85)
    tried = match.candidates(src, main, *args).select("_lk", "_rk").distinct().count()
    passed = match.similar_pairs(src, main, *args)
    assert {(r["_lk"], r["_rk"]) for r in passed.collect()} >= {(k, k) for k in range(400)}
    assert passed.count() == 400 and tried <= 5 * 400, tried


def test_short_names_make_few_candidates_in_a_large_block(spark):
    """Names of two edits in one block: long segments lead to few pairs that do not pass, and lose none."""
    names = [(k, hashlib.md5(str(k // 3).encode()).hexdigest()[:13] + str(k % 3), "T") for k in range(900)]
    main = spark.createDataFrame(names, "k int, name string, tax string")
    src = main.withColumn("name", F.concat(F.substring("name", 1, 5), F.lit("~"), F.substring("name", 7, 8)))
    args = ("k", "k", "name", "name", "tax", "tax", 0.8)
    tried = match.candidates(src, main, *args).select("_lk", "_rk").distinct().count()
    passed = [(r["_lk"], r["_rk"]) for r in match.similar_pairs(src, main, *args).collect()]
    assert sorted(passed) == sorted((a, b) for a in range(900) for b in range(a - a % 3, a - a % 3 + 3))
    assert tried <= 2 * len(passed), tried


def test_names_of_many_edits_make_few_candidates_in_a_large_block(spark):
    """Names of one prefix and five edits: long segments are cut where names differ, lead to few pairs that do not pass."""
    names = [(k, f"Customer#{k % 40:09d} of {hashlib.md5(str(k).encode()).hexdigest()[:16]}", "T") for k in range(3000)]
    main = spark.createDataFrame(names, "k int, name string, tax string")
    src = main.withColumn("name", F.concat(F.substring("name", 1, 24), F.lit("~"), F.substring("name", 26, 20)))
    args = ("k", "k", "name", "name", "tax", "tax", 0.85)
    tried = match.candidates(src, main, *args).select("_lk", "_rk").distinct().count()
    passed = [(r["_lk"], r["_rk"]) for r in match.similar_pairs(src, main, *args).collect()]
    assert sorted(passed) == [(k, k) for k in range(3000)]
    assert tried <= 2 * 3000, tried


def test_names_of_many_edits_in_a_large_block_equal_brute_force(spark, monkeypatch):
    """Up to six edits of any kind and place, common segments or none, blocks with a cut or without: no pair is lost."""
    monkeypatch.setattr(match, "COMMON", 8)
    rnd = random.Random(11)

    def text(a, n):
        return "".join(rnd.choice(a) for _ in range(n))
    base = ["Acme " + text("abcdef0123", rnd.randint(15, 19)) + rnd.choice(["", " Inc"]) for _ in range(40)]
    right, left = [], []
    for i in range(160):
        right.append((f"R{i}", rnd.choice("xy"), rnd.choice(base[:30]) if i % 2 else "Acme " + text("abc", 17)))
    for i in range(160):
        s = list(rnd.choice(right)[2])
        for _ in range(rnd.randint(0, 6)):
            place = rnd.choice([0, len(s) - 1, rnd.randrange(len(s))])
            kind = rnd.randint(0, 2)
            if kind == 0:
                s[place] = rnd.choice("abcz")
            elif kind == 1:
                del s[place]
            else:
                s.insert(place + rnd.randint(0, 1), rnd.choice("abcz"))
        left.append((f"L{i}", rnd.choice("xy"), "".join(s)))
    for t in (0.8, 0.83):
        assert spark_pairs(spark, left, right, t) == brute_pairs(left, right, t)
