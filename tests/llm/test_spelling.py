"""Spelling variants against comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import spelling as q


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute_words(docs, least=6, times=5):
    total = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= times}


def brute(words, ratio=5):
    out, form = {}, {}
    by_hole = {}
    for w in words:
        for k in range(len(w) + 1):
            by_hole.setdefault(w[:k] + w[k + 1:], set()).add(w)     # w itself too, at the end
    for w in words:
        maybe = set().union(*(by_hole.get(w[:k] + w[k + 1:], set()) for k in range(len(w) + 1)))
        near = [x for x in maybe if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
        out[w] = len(near)
    rows = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, n, out[w], form[w], words[form[w]] if form[w] else None, root))
    return rows


def vocabulary(seed, n, alphabet, lengths):
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.choice(lengths))) for _ in range(n)}
    for w in list(words)[:n // 2]:
        k = rng.randrange(len(w) + 1)
        words |= {w[:k] + rng.choice(alphabet) + w[k:], w[:k] + rng.choice(alphabet) + w[k + 1:], w[:k] + w[k + 1:]}
    return sorted(w for w in words if len(w) >= 6)


@pytest.mark.parametrize("alphabet, lengths", [("ab", [6, 7, 8]), ("abé÷", [6, 7, 30]), ("abcdefgh", [6, 9])])
def test_scan_of_one_list(alphabet, lengths):
    words = vocabulary(3, 150, alphabet, lengths)
    lists = q.WordList(words, np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64))
    want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])}
    for states in (1, 500, 1 << 18):
        x, y = q.pairs_within(lists, states)
        got = list(zip(x.tolist(), y.tolist()))
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("options", [{}, {"most": 3, "bucket": 50}, {"most": 1, "bucket": 7}])
def test_near_pairs_over_lists(spark, options):
    words = vocabulary(5, 120, "abc", [6, 7, 8, 9]) + ["z" * 400, "z" * 401, "z" * 399 + "y"]
    df = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long").repartition(3)
    got = [(r["word"], r["near"], r["near_n"]) for r in q.near_pairs(df, **options).collect()]
    want = {(v, w, len(w)) for v in words for w in words if one_edit(v, w)}
    assert len(got) == len(set(got)) and set(got) == want


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = brute_words((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    want = brute(words)
    assert rows(q.variants(docs)) == sorted(map(repr, want))
    assert len(words) > 500 and any(r[2] for r in want) and any(r[3] for r in want)


def test_chains_and_ties(spark, none):
    count = {"abcdefg": 5, "abcdefgh": 25, "abcdefghi": 125, "abcdefghij": 625, "zbcdefgh": 25, "abcdefgx": 24,
             "tiesab": 5, "tiesac": 30, "tiesad": 30, "tiesae": 4, "Études": 30, "études": 6}
    docs = spark.createDataFrame([(k, f"{w} " * n, "s") for k, (w, n) in enumerate(count.items())], none.schema)
    words = brute_words((r["doc_id"], r["text"]) for r in docs.collect())
    assert words == {w: n for w, n in count.items() if n >= 5}          # no deletion among these
    got = {r["word"]: r for r in q.variants(docs).collect()}
    assert rows(q.variants(docs)) == sorted(map(repr, brute(words)))
    assert got["abcdefg"]["root"] == "abcdefghij" and got["abcdefg"]["form"] == "abcdefgh"
    assert got["tiesab"]["form"] == "tiesac" and got["études"]["form"] == "Études"


def test_odd_rows(spark, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    words = brute_words(docs, times=1)
    assert "x" * 50_000 in words and rows(q.variants(odd, times=1)) == sorted(map(repr, brute(words)))
    assert q.variants(none).count() == 0 and q.variants(odd.where("text is null")).count() == 0
