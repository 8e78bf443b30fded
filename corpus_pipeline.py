"""A training corpus from ``documents``: five stages, each on what the last one kept.

1. quality_rules: documents that a rule rejects go.
2. line_dedup: runs of lines that occur earlier, of three lines or of 50 words,
   are deleted; a document with nothing left goes.  ``n_chars`` follows the text.
3. simhash: one document of each near-duplicate group stays.
4. decontaminate: documents with a benchmark passage go.
5. byte_bpe: the documents as token ids, with a digest of the ids and of the
   bytes they decode to, in place of the text.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; ``run`` writes its
result as Parquet to the shared folder of ``spark.checkpoint.dir`` and reads
it again for the next, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, line_dedup, quality_rules, simhash
from ledgerline.llm import decontaminate as benchmark_windows
from ledgerline.llm.common import read, scratch
from ledgerline.llm.q_bpe import tokenizer
from ledgerline.llm.q_lines import PASSAGE_WORDS
from ledgerline.llm.q_simhash import MAX_BITS, WIDTH


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeats(docs, passage_words=PASSAGE_WORDS).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, WIDTH, MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmark_windows.decontaminate(docs, read(spark, sf_dir, "benchmark"), mode="drop")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, tokenizer(spark)).drop("text")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash", near_duplicates),
    ("decontaminate", decontaminate),
    ("byte_bpe", tokens),
]

# The merges of the tokenizer and the fingerprints cannot be written in SQL;
# tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
