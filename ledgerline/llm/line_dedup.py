"""Line deduplication by winnowing [native].

A document is a sequence of lines (blank lines belong to the line before
them).  Every ``gram`` consecutive lines have a hash, and of every ``window``
consecutive gram hashes the least (the last of equal ones) is selected as a
fingerprint, which guarantees that any run of ``gram + window - 1`` lines that
occurs twice has a fingerprint in common.  Only selected positions are kept,
with the hashes of the few lines around them.  Those whose fingerprint occurs at two
places or more are joined on; from them a match extends to both sides by
comparing the lines around: every run of the guaranteed length around the
fingerprint, equal by a 128-bit hash of its lines.  Of equal runs the first
(least doc_id, then place) stays and all lines of the later ones are deleted,
so overlapping runs join to longer ones.

With ``passage_words``, runs of fewer lines that have so many words together
count as well: each is its own fingerprint and does not extend.

No pairs of places are made: every group of equal runs is reduced to its first
place by partial aggregation, and joined back to its members.  Both sides of
each join are written tables, so that a hot fingerprint can be split.

Defined cases: a null text is an empty text and has one blank line; lines are
compared without blanks at their ends; rows with equal id and text are one
document, and each of them is returned with the same result; rows with equal
id and different texts are ordered by a hash of the text; a null id comes
last; an empty table gives an empty table; the result replaces columns of the
same names and passes others through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BLANK_RUN, BLANKS, aside, let, text_of, written

# a line break before a line that is not blank
BREAK = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"


def lines_of(text: Column) -> Column:
    return F.split(text, BREAK, -1)


def _hashes(lines: Column, words: bool) -> Column:
    """Two independent 64-bit hashes of each line; its number of words where asked for."""
    def both(line: Column) -> Column:
        bare = F.btrim(line, F.lit(BLANKS))
        count = [F.when(bare == "", 0).otherwise(F.size(F.split(bare, BLANK_RUN))).alias("words")] if words else []
        return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("line"), bare).alias("b"), *count)
    return F.transform(lines, both)


def selected(text: Column, gram: int, window: int, passage_words: int | None = None) -> Column:
    """The selected positions of a text: fingerprint (fp), place (at), and the lines from ``first`` on around it.

    ``lines`` is the length of the runs to compare there.  With
    ``passage_words`` also every run of fewer lines that reaches so many words.
    """
    size = gram + window - 1
    none = F.expr("CAST(array() AS array<struct<fp:bigint,at:int,first:int,lines:int,"
                  "near:array<struct<a:bigint,b:bigint>>>>)")

    def bare(h: Column, first: Column, n: Column | int) -> Column:
        return F.transform(F.slice(h, first + 1, n), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))

    def minima(h: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(h) - gram),
                            lambda i: F.struct(F.xxhash64(*[F.get(h, i + k)["a"] for k in range(gram)]).alias("fp"),
                                               (-i).alias("back")))

        def least(g: Column, i: Column) -> Column:
            return F.least(*[F.get(g, i + k) for k in range(window)]) if window > 1 else F.get(g, i)

        def around(m: Column) -> Column:
            at = -m["back"]
            first = F.greatest(at - (window - 1), F.lit(0))
            return F.struct(m["fp"].alias("fp"), at.alias("at"), first.alias("first"), F.lit(size).alias("lines"),
                            bare(h, first, F.least(at + size, F.size(h)) - first).alias("near"))
        chosen = let(grams, lambda g: F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(h) - size),
                                                                   lambda i: least(g, i))))
        return F.transform(chosen, around)

    def passages(h: Column, n: int) -> Column:
        def one(i: Column) -> Column:
            fp = F.xxhash64(F.lit(n), *[F.get(h, i + k)["a"] for k in range(n)])
            return F.struct(fp.alias("fp"), i.alias("at"), i.alias("first"), F.lit(n).alias("lines"),
                            bare(h, i, n).alias("near"))

        def enough(i: Column) -> Column:
            return sum((F.get(h, i + k)["words"] for k in range(1, n)), F.get(h, i)["words"]) >= passage_words
        places = F.filter(F.sequence(F.lit(0), F.size(h) - n), enough)
        return F.when(F.size(h) >= n, F.transform(places, one)).otherwise(none)

    def all_of(h: Column) -> Column:
        whole = F.when(F.size(h) >= size, minima(h))
        if passage_words is None:
            return whole
        return F.concat(F.coalesce(whole, none), *[passages(h, n) for n in range(1, size)])

    return let(_hashes(lines_of(text), passage_words is not None), all_of)


def extended() -> Column:
    """The runs of ``lines`` lines around a shared position: start and 128-bit hash (a, b)."""
    def run(k: Column) -> Column:
        lines = F.slice("near", k + 1, F.col("lines"))
        # the hash of an array is that of its elements in turn
        return F.struct((F.col("first") + k).alias("start"),
                        F.xxhash64("lines", F.transform(lines, lambda x: x["a"])).alias("a"),
                        F.xxhash64("lines", F.transform(lines, lambda x: x["b"])).alias("b"))
    return F.transform(F.sequence(F.lit(0), F.size("near") - F.col("lines")), run)


def repeated_runs(docs: DataFrame, gram: int, window: int, id_col: str, text: str,
                  passage_words: int | None = None) -> DataFrame:
    """(id, text_hash, start, lines) of every run that also occurs earlier."""
    t = text_of(text)
    spots = written(docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("text_hash"),
                                F.explode(selected(t, gram, window, passage_words)).alias("r"))
                    .select("id", "text_hash", "r.*"), "line-spots")
    spot = F.struct("id", "text_hash", "at")
    shared = written(spots.groupBy("fp").agg(F.min(spot).alias("head"), F.max(spot).alias("tail"))
                     .where(~F.col("head").eqNullSafe(F.col("tail"))).select("fp"), "line-fingerprints")
    runs = written(spots.join(shared, "fp", "left_semi").select("id", "text_hash", "lines", F.explode(extended()).alias("r"))
                   .select("id", "text_hash", "lines", "r.*"), "line-runs")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", "start")
    first = written(runs.groupBy("a", "b").agg(F.min(place).alias("head"), F.max(place).alias("tail"))
                    .where(~F.col("head").eqNullSafe(F.col("tail"))).select("a", "b", "head"), "line-firsts")
    return (runs.join(first, ["a", "b"]).where(~place.eqNullSafe(F.col("head")))
            .select("id", "text_hash", "start", "lines"))


def dedup(docs: DataFrame, gram: int = 2, window: int = 2, id_col: str = "doc_id", text: str = "text",
          passage_words: int | None = None) -> DataFrame:
    """``docs`` with later repeated runs deleted from ``text``, and n_lines, n_removed, n_runs."""
    if gram < 1 or window < 1 or (passage_words is not None and passage_words < 1):
        raise ValueError("gram, window and passage_words are at least 1")
    later = (repeated_runs(docs, gram, window, id_col, text, passage_words).groupBy("id", "text_hash")
             .agg(F.collect_set(F.struct("start", "lines")).alias("__runs"))
             .withColumnsRenamed({"id": "__id", "text_hash": "__hash"}))
    joined = docs.join(later, F.col(id_col).eqNullSafe(F.col("__id"))
                       & (F.xxhash64(text_of(text)) == F.col("__hash")), "left")
    gone = F.sort_array(F.array_distinct(F.flatten(F.transform(
        "__runs", lambda r: F.sequence(r["start"], r["start"] + r["lines"] - 1)))))
    heads = let(gone, lambda g: F.size(F.filter(g, lambda i, k: F.coalesce(i - F.get(g, k - 1) > 1, F.lit(True)))))

    def rest(lines: Column) -> Column:
        keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")

    whole = F.col("__runs").isNull()
    t = text_of(text)
    return joined.withColumns({
        "n_lines": F.size(lines_of(t)).cast("long"),
        "n_removed": F.when(whole, 0).otherwise(F.size(gone)).cast("long"),
        "n_runs": F.when(whole, 0).otherwise(heads).cast("long"),
        text: F.when(whole, F.col(text)).otherwise(let(lines_of(t), rest))}).drop("__id", "__hash", "__runs")


def drop_repeats(docs: DataFrame, gram: int = 2, window: int = 2, id_col: str = "doc_id",
                 text: str = "text", passage_words: int | None = None) -> DataFrame:
    """``docs`` with repeated runs deleted; documents of which nothing but blanks is left are dropped."""
    docs, back = aside(docs, ["n_lines", "n_removed", "n_runs"])
    done = dedup(docs, gram, window, id_col, text, passage_words)
    return (done.where((F.col("n_removed") == 0) | (F.btrim(F.col(text), F.lit(BLANKS)) != ""))
            .select(*docs.columns).withColumnsRenamed(back))
