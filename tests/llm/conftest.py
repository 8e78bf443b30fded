import pytest

LONG = "abcdefgh " * 30_000
ODD = [      # doc_id, text, source: nulls, empty and blank texts, repeated rows, one id twice, a very long text
    (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\f\r ", None), (4, "One word.", "b"), (4, "One word.", "b"),
    (5, "first text of five", "b"), (5, "second text of five", "c"), (None, "no id here", None), (None, None, None),
    (6, LONG, "a"), (7, "x" * 50_000, "a"), (8, "line one\nline two\nline three\n\nline four\n", "a"),
    (9, "line one\nline two\nline three\nline four", "c"), (10, "é漢字\U0001f600 ñ " * 40, "a"),
]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents, with extra columns named like the operators' outputs."""
    from pyspark.sql import functions as F
    names = ["spans", "ids", "n_words", "hit_ranges", "n_lines", "n_removed", "kept", "removed", "fingerprint",
             "n_tokens", "n_repeat_words", "text_hash", "id", "a", "start"]
    return (spark.createDataFrame(ODD, SCHEMA).repartition(3)
            .withColumns({n: F.lit(f"own {n}") for n in names}))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
