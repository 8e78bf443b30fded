import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerline.llm import quality_rules as q


def stats(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


def test_statistics(spark, odd, none):
    texts = ["a b c a b c", "a a a a", "a a a", "one two", "a|b #*$%&|<> \n x\nx\n x\n", "w " * 200,
             "a b c d a b c e b c d", "ü ñ\u00a0x y ü ñ\u00a0x y z"]
    docs = odd.select("doc_id", "text", "source").unionByName(
        spark.createDataFrame([(100 + k, t, "s") for k, t in enumerate(texts)], none.schema))
    for r in q.measure(docs).collect():
        assert {k: r[k] for k in q.FEATURES} == stats(r["text"] or ""), r["text"][:60]


def test_order_does_not_change_verdicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    f = q.FromColumns()
    m = q.measure(docs)
    a = m.select("doc_id", q.keep(f, q.RULES).alias("k"))
    b = m.select("doc_id", q.keep(f, q.RULES[::-1]).alias("k"))
    assert a.exceptAll(b).count() == 0
    assert q.quality_filter(docs).count() == a.where("k").count()


def test_plan_puts_the_cheap_and_selective_rule_first(spark, none):
    docs = spark.createDataFrame([(k, "few words", "s") for k in range(400)], none.schema)
    planned = q.plan_cascade(docs, fraction=1.0)
    assert planned[0].rejected == 1.0 and {c.rule.name for c in planned} == {r.name for r in q.RULES}
    assert [c.rule for c in q.plan_cascade(none)] == list(q.RULES)


def test_a_costly_rule_is_moved_back_and_the_order_is_stable(spark):
    """Two rules reject the same rows; the one that computes much for it comes later, run after run."""
    def dear(f):
        h = F.col("text")
        for _ in range(40):
            h = F.sha2(h, 512)
        return F.startswith(h, F.lit("no hash")) | (f.n_words < 60)
    rules = (q.Rule("dear", dear), q.Rule("cheap", lambda f: f.n_words < 60), q.Rule("never", lambda f: f.n_words < 0))
    docs = spark.createDataFrame([(k, "some words " * (k % 60 + 1)) for k in range(400)], "doc_id long, text string")
    for _ in range(4):
        planned = q.plan_cascade(docs, rules, fraction=1.0)
        assert [c.rule.name for c in planned] == ["cheap", "dear", "never"]
        cost = {c.rule.name: c.seconds for c in planned}
        assert cost["dear"] > 2 * cost["cheap"]


def test_clean_labelled_documents_stay(spark):
    """Of the documents labelled good, the method's own rules reject hardly any."""
    d = "/root/testdata/sf0.1"
    good = spark.read.parquet(f"{d}/labels.parquet").where("quality = 1").select("doc_id")
    m = q.measure(spark.read.parquet(f"{d}/documents.parquet").join(good, "doc_id", "left_semi"))
    f = q.FromColumns()
    lost = m.where(~q.keep(f, q.METHOD_RULES) & q.keep(f, q.BASE_RULES)).count()
    assert lost <= 0.002 * m.count()


def test_odd_rows(odd, none):
    out = q.quality_filter(odd)
    assert out.columns == odd.columns
    assert q.quality_filter(none).count() == 0
