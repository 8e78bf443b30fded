import random

import pytest

from ledgerline.llm import line_dedup as q

BLANKS = " \t\n\x0b\f\r"


def units(text):
    out = []
    for line in text.split("\n"):
        if out and (not line.strip(BLANKS)):
            out[-1] += "\n" + line
        else:
            out.append(line)
    return out


def brute(docs, size, passage_words=None):
    seen, out = set(), {}
    for key, text in docs:
        u = units(text)
        bare = [x.strip(BLANKS) for x in u]
        gone = set()
        for n in range(1, size + 1):
            for i in range(len(u) - n + 1):
                run = tuple(bare[i:i + n])
                if n < size and (passage_words is None or sum(len(x.encode().split()) for x in run) < passage_words):
                    continue
                if run in seen:
                    gone.update(range(i, i + n))
                seen.add(run)
        runs = sum(i - 1 not in gone for i in gone)
        out[key] = len(u), len(gone), runs, "\n".join(x for i, x in enumerate(u) if i not in gone)
    return out


def test_lines_are_split_before_lines_with_words(spark):
    from pyspark.sql import functions as F
    for t in ["", "a", "a\n", "\n\na\n \n\nb\n\n", "a\nb", " \n\t", "\x0b\na\r\n\r\nb", "a\n\n\nb\nc"]:
        got = spark.createDataFrame([(t,)], "t string").select(q.lines_of(F.col("t"))).first()[0]
        assert "\n".join(got) == t
        assert [x for x in got if x.strip(BLANKS)] == [x for x in units(t) if x.strip(BLANKS)]


@pytest.mark.parametrize("gram, window, words", [(2, 2, None), (1, 1, None), (1, 4, 3), (3, 3, None), (2, 2, 2), (3, 1, 4)])
def test_random_corpus(spark, none, gram, window, words):
    rng = random.Random(gram * 10 + window)
    lines = [rng.choice(["alpha", "beta ", "gamma", "  delta", "eps", "zeta"]) for _ in range(6)]
    texts = ["\n".join(rng.choice(lines + ["", f"own {k}"]) for _ in range(rng.randint(0, 25))).lstrip("\n")
             for k in range(60)]
    texts += [texts[3], texts[3] + "\nmore", "x\n" * 50]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], none.schema).repartition(4)
    want = brute(list(enumerate(texts)), gram + window - 1, words)
    for r in q.dedup(docs, gram, window, passage_words=words).collect():
        assert (r["n_lines"], r["n_removed"], r["n_runs"], r["text"]) == want[r["doc_id"]]


def test_odd_rows(spark, odd, none):
    got = {}
    for r in q.dedup(odd).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [r["text"] for r in got[4]] == ["One word."] * 2
    assert got[1][0]["text"] is None and got[2][0]["text"] == ""
    assert got[8][0]["n_removed"] == 0 and got[9][0]["n_removed"] == 4 and got[9][0]["text"] == ""
    kept = q.drop_repeats(odd)
    assert kept.columns == odd.columns and kept.first()["n_lines"] == "own n_lines"
    assert 9 not in [r["doc_id"] for r in kept.collect()]
    assert q.dedup(none).count() == 0
    with pytest.raises(ValueError):
        q.dedup(odd, gram=0)


def test_passages_of_fewer_lines(spark, none):
    words = lambda p, n: " ".join(f"{p}{k}" for k in range(n))
    long, half, rest, short = words("l", 60), words("h", 30), words("r", 30), words("s", 9)
    texts = [f"{long}\none\n{half}\n{rest}\ntwo\n{short}", long, f"three\n {long} \nfour", f"{half}\n{rest}\nfive",
             f"{half}\nsix\n{rest}", f"{short}\nseven\n{half}", f"{long}\n{long}\n{words('n', 60)}"]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], none.schema).repartition(3)
    got = {r["doc_id"]: (r["n_removed"], r["n_runs"], r["text"]) for r in q.dedup(docs, passage_words=50).collect()}
    assert got == {0: (0, 0, texts[0]), 1: (1, 1, ""), 2: (1, 1, "three\nfour"), 3: (2, 1, "five"), 4: (0, 0, texts[4]),
                   5: (0, 0, texts[5]), 6: (2, 1, words("n", 60))}
    assert {r["n_removed"] for r in q.dedup(docs).collect()} == {0}
