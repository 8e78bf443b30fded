"""Chat formatting with perspective rotation [native].

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant and all others as named users; the loss mask
covers what the assistant says, and its end mark.  Speakers listed as
``system`` are no participants and stay system in every view.

A dialogue is cut into pieces of ``piece_turns`` consecutive turn numbers, one
row each, so a conversation of any length is rendered by many tasks if its turn
numbers differ.  Where many rows share a number (null turns, a null
conversation id), ``by_rows`` cuts by a running count of the rows and of their
text instead, which bounds every piece.

Defined cases: a null or blank speaker is the participant ``unknown``; a null
content is empty; a null conversation id is one conversation; turns with the
same number are ordered by speaker, then content, and repeated rows are all
rendered; a null turn comes first, as turn 0; control marks inside
a content are broken up; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BLANKS
from ledgerline.operators.windows import running_sum

BEGIN, END = "<|im_start|>", "<|im_end|>"


def _safe(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(BEGIN), F.lit("<|im_start |>")), F.lit(END), F.lit("<|im_end |>"))


def _body(content: Column) -> Column:
    return F.concat(_safe(content), F.lit(END))


def views(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", content: str = "text",
          system: tuple[str, ...] = ("system",), piece_turns: int = 256,
          by_rows: bool = False, piece_chars: int = 1 << 20) -> DataFrame:
    """One row per turn and perspective: header, body, and whether the loss covers the body.

    With ``by_rows`` a piece has at most ``piece_turns`` rows and ``piece_chars``
    characters of them, its last row apart; piece numbers may skip.
    It runs a job when called.
    """
    name = F.btrim(F.coalesce(F.col(speaker).cast("string"), F.lit("")), F.lit(BLANKS))
    t = turns.select(F.col(conv).alias("conv_id"), F.coalesce(F.col(turn), F.lit(0)).cast("long").alias("turn"),
                     F.col(turn).isNotNull().alias("numbered"),
                     F.when(name == "", "unknown").otherwise(name).alias("speaker"),
                     F.coalesce(F.col(content).cast("string"), F.lit("")).alias("content"))
    if by_rows:
        # a row weighs 1 / piece_turns of a piece, a long one its share of the characters
        chars = F.length("speaker") + F.length("content")
        t = t.withColumn("__weight", F.greatest(F.lit(piece_chars).cast("long"), chars.cast("long") * piece_turns))
        order = ["numbered", "turn", "speaker", "content", F.xxhash64(F.monotonically_increasing_id())]
        t = running_sum(t, ["conv_id"], order, "__weight", "__upto")
        t = t.withColumn("piece", F.expr(f"(__upto - __weight) div {piece_chars * piece_turns}")).drop("__weight", "__upto")
    else:
        t = t.withColumn("piece", F.floor(F.col("turn") / piece_turns).cast("long"))
    cast = (t.where(~F.col("speaker").isin(*system)).groupBy("conv_id", "speaker").agg(F.lit(1).alias("__one"))
            .select(F.col("conv_id").alias("__conv"), F.col("speaker").alias("perspective")))
    seen = t.join(cast, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    mine, rules = F.col("speaker") == F.col("perspective"), F.col("speaker").isin(*system)
    role = (F.when(rules, F.lit("system")).when(mine, F.lit("assistant"))
            .otherwise(F.concat(F.lit("user name="), _safe(F.col("speaker")))))
    return seen.select("conv_id", "perspective", "piece", "numbered", "turn", "speaker", "content",
                       F.concat(F.lit(BEGIN), role, F.lit("\n")).alias("head"),
                       _body(F.col("content")).alias("body"), mine.alias("trained"))


def dialogues(seen: DataFrame) -> DataFrame:
    """Pieces of whole dialogues: text, and ``mask``, the spans (code points, end exclusive) that the loss covers."""
    # the body is made of the content once the rows have met, so that a text is shuffled once and not twice
    row = F.struct("numbered", "turn", "speaker", "content", "head", "trained")
    pieces = (seen.groupBy("conv_id", "perspective", "piece")
              .agg(F.sort_array(F.collect_list(row)).alias("rows")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)")
                    .alias("spans"))

    def add(acc, r):
        start = acc["at"] + F.length(r["head"])
        end = start + F.length(_body(r["content"]))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"),
                        F.when(r["trained"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    text = F.array_join(F.transform("rows", lambda r: F.concat(r["head"], _body(r["content"]), F.lit("\n"))), "")
    return pieces.select("conv_id", "perspective", "piece", F.size("rows").cast("long").alias("n_turns"),
                         text.alias("text"), F.aggregate("rows", zero, add, lambda acc: acc["spans"]).alias("mask"))


def rotate(turns: DataFrame, **columns) -> DataFrame:
    """Every conversation from the perspective of each of its participants."""
    return dialogues(views(turns, **columns))
