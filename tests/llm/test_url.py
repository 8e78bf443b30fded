import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import url_filter as u
from ledgerline.llm.q_url import RULES

URLS = ["http://Example.NET/en/1?x=/de/#y", "https://a.b.example.com/de/x", "https://example.com/de", "http://x.net",
        "http://x.net/", "http://xnet/", "ftp://org/fr/a", "http://a.org/fr/?q", "noscheme/net/", None, "", "://net/",
        "http://a.net?x://b.org/fr/", "http://example.com/de/://", "http://notexample.com/de/", "http://a.org:80/fr/",
        "x" * 5000, "http://ÄB.net/ü"]


def brute(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    k = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k])
    path = rest[k:]
    k = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return host, path[:k]


def rule_of(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)).text if fits else None


def test_host_path_and_rule(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    for r in u.with_rules(pages, RULES).collect():
        assert (r["host"], r["path"]) == brute(r["url"]), r["url"]
        assert r["rule"] == rule_of(r["host"], r["path"])


def test_entropy(spark):
    for t in ("", "aaaa", "abcd", "http://a.b/ccc", "äöüä"):
        got = spark.createDataFrame([(t,)], "t string").select(u.entropy(F.col("t"))).first()[0]
        want = -sum(n / len(t) * math.log2(n / len(t)) for n in Counter(t).values()) if t else 0.0
        assert got == pytest.approx(want)


def test_held_out_accuracy(spark):
    """Learned from four fifths of the labelled urls, the trees judge the rest far better than the common verdict."""
    pages = u.with_rules(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), RULES)
    held_out = F.pmod(F.xxhash64("page_id"), F.lit(5)) == 0
    features = u.featurize(pages, pages.where(~held_out))
    model = u.train(features.where(F.col("ruled").isNotNull() & ~held_out))
    held = u.judge(features.where(F.col("ruled").isNotNull() & held_out), model)
    right = held.agg(F.avg((F.col("judged") == F.col("ruled")).cast("double"))).first()[0]
    common = max(r["count"] for r in held.groupBy("ruled").count().collect()) / held.count()
    assert right > 0.9 and right > common


def test_shares_are_out_of_fold(spark):
    """A labelled page's share counts the labelled pages of other folds, any other page's all of them."""
    urls = [f"http://h{k}.{t}/{s}/x" for k in range(40) for t in ("net", "org", "dev") for s in ("fr", "de")]
    pages = u.with_rules(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), RULES)
    rows = u.featurize(pages, pages).withColumn("fold", u.fold()).collect()
    for r in rows:
        mine = [x for x in rows if x["ruled"] and x["suffix"] == r["suffix"] and not (r["ruled"] and x["fold"] == r["fold"])]
        want = (sum(x["ruled"] == u.BLOCK for x in mine) + 5) / (len(mine) + 10)
        assert r["f_suffix_blocked"] == pytest.approx(want), r["url"]


def test_what_the_trees_know_beyond_a_rule(spark):
    """Each rule's pages are held out in turn: reported, and better than nothing on some, since only urls are seen."""
    pages = u.with_rules(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), RULES)
    right = {}
    for r in RULES:
        mine = F.coalesce(F.col("rule") == r.text, F.lit(False))
        features = u.featurize(pages, pages.where(~mine))
        model = u.train(features.where(F.col("ruled").isNotNull() & ~mine))
        held = u.judge(features.where(mine), model)
        right[r.text] = held.agg(F.avg((F.col("judged") == F.col("ruled")).cast("double"))).first()[0]
    print("held-out rules:", right)
    assert len(right) == len(RULES) and all(v is None or 0.0 <= v <= 1.0 for v in right.values())


def test_labels_of_one_kind_and_none(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.dev/")], "page_id long, url string")
    assert {r["verdict"] for r in u.filter_urls(pages, RULES).collect()} == {u.BLOCK}
    assert {r["verdict"] for r in u.filter_urls(pages, ()).collect()} == {u.ALLOW}
    assert u.filter_urls(pages.limit(0), RULES).count() == 0


def test_odd_rows(spark):
    rows = list(enumerate(URLS)) * 2 + [(None, None), (None, "http://q.dev/a")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit("own") for c in ("host", "rule", "suffix", "label", "features", "f_length")})
    out = u.filter_urls(pages, RULES)
    assert out.count() == len(rows) and out.where("verdict IS NULL").count() == 0
