"""The pipeline against a plain Python version of its five stages."""

import hashlib
import sys

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from ledgerline.llm import bpe
from ledgerline.llm.q_bpe import RANKS

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import test_decontaminate as leaks  # noqa: E402
import test_lines as lines  # noqa: E402
import test_quality as quality  # noqa: E402
import test_simhash as simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def good(text):
    s = quality.stats(text)
    return not (s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"] or 100 * s["n_symbols"] > 30 * s["n_words"]
                or not 2 * s["n_words"] <= s["word_chars"] <= 20 * s["n_words"]
                or 100 * s["n_dup_lines"] > 50 * s["n_lines"])


def test_pipeline(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = {k: t for k, t in sorted(docs.items()) if good(t)}
    deduped = lines.brute(docs.items(), 3, 50)
    docs = {k: deduped[k][3] for k in docs if not deduped[k][1] or deduped[k][3].strip(lines.BLANKS)}
    ids = list(docs)
    label = simhash.brute_groups([simhash.brute_print(docs[k]) for k in ids])
    docs = {ids[k]: docs[ids[k]] for k in sorted(set(label.tolist()))}
    docs = {k: t for k, t in docs.items() if not leaks.brute(t, items)[1]}
    with open(public_tokenizers.path(RANKS), "rb") as f:
        ranks = bpe.Codec(f.read(), public_tokenizers.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(got) == sorted(docs) and len(docs) > 100
    for k, t in docs.items():
        want = library.encode_ordinary(t)
        assert got[k]["ids"] == want and got[k]["n_tokens"] == len(want) and got[k]["n_chars"] == len(t)
        assert got[k]["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_stages_take_odd_and_empty_tables(spark, odd):
    for docs in (odd, odd.limit(0)):
        docs = docs.withColumn("lang", docs["source"]).withColumn("n_chars", docs["doc_id"])
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
            assert docs.columns == columns, name
            docs = docs.unionByName(odd.withColumn("lang", odd["source"]).withColumn("n_chars", odd["doc_id"]))
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
