"""Quality rules: a short-circuit cascade of cheap text rules [native].

Every rule rejects on one or two text statistics.  ``plan_cascade`` measures,
on a small sample, how long each rule takes and what share of rows it rejects,
and orders the rules by rejection per cost.  A job over a small sample takes
about the same whatever it computes, so the sample is repeated until a rule's
time stands out from that of a run without rules, which is subtracted; costs
count by powers of two, so that noise does not turn the order.  ``keep`` then
evaluates the rules as one CASE expression, so a row rejected by an early rule never pays for the
later ones.  The order changes the cost only: a document is kept when no rule
rejects it, in any order.

Defined cases: a null text is an empty text (no words, hence rejected by
``few_words``); repeated rows are judged one by one; other columns are passed
through untouched, null or not; an empty table gives an empty table and leaves
the rules in their given order.  Whole texts are judged, whatever their size.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BLANKS, let, text_of, words_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Parts:
    """A text with its words, and its lines that hold a word."""
    text: Column
    words: Column
    lines: Column


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")


def repeat_words(words: Column, width: int = 3) -> Column:
    """Words covered by ``width``-word windows that occur at least twice.

    Windows are hashed; where all hashes differ nothing repeats.  Otherwise
    they are sorted with their positions, so equal windows are neighbours:
    n log n in the length of a text, not its square.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - width),
                         lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))

    def starts(s):
        twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p):
        steps = F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(h):
        places = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(places, lambda s: let(starts(s), covered))

    none = F.lit(0).cast("long")
    return F.when(F.size(words) > width, let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), none).otherwise(repeated(h)))).otherwise(none)


FEATURES: dict[str, Callable[[Parts], Column]] = {
    "n_words": lambda p: F.size(p.words).cast("long"),
    "word_chars": lambda p: F.length(F.translate(p.text, BLANKS, "")).cast("long"),
    "n_symbols": lambda p: (F.length(p.text) - F.length(F.translate(p.text, SYMBOLS, ""))).cast("long"),
    "n_lines": lambda p: F.size(p.lines).cast("long"),
    "n_dup_lines": lambda p: let(p.lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    "n_repeat_words": lambda p: repeat_words(p.words),
}


class FromParts:
    """Statistics as expressions over a text's parts; each is computed where it is used."""

    def __init__(self, parts: Parts):
        self._parts = parts

    def __getattr__(self, name: str) -> Column:
        return FEATURES[name](self._parts)


class FromColumns:
    """Statistics that are columns already."""

    def __getattr__(self, name: str) -> Column:
        return F.col(name)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[FromParts | FromColumns], Column]


BASE_RULES = (
    Rule("few_words", lambda f: f.n_words < 50),
    Rule("repeated_windows", lambda f: 100 * f.n_repeat_words > 50 * f.n_words),
)
METHOD_RULES = (
    Rule("many_symbols", lambda f: 100 * f.n_symbols > 30 * f.n_words),
    Rule("word_length", lambda f: (f.word_chars < 2 * f.n_words) | (f.word_chars > 20 * f.n_words)),
    Rule("repeated_lines", lambda f: 100 * f.n_dup_lines > 50 * f.n_lines),
)
RULES = BASE_RULES + METHOD_RULES


@dataclass(frozen=True)
class RuleCost:
    """``seconds`` a row beyond a run without rules, and the share of rows rejected."""
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        """Rejection per cost, the cost as a power of two."""
        return self.rejected / 2.0 ** round(math.log2(max(self.seconds, 1e-9)))


def plan_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = 500,
                 fraction: float = 0.05, seed: int = 7, least_seconds: float = 0.2, most_repeats: int = 256,
                 runs: int = 3) -> list[RuleCost]:
    """Rules with measured cost and rejected share, best rejection per cost first.

    The sample (at most ``sample_rows`` rows, each row taken with probability
    ``fraction``) serves the order only; no verdict depends on it.  ``take``
    reads only as many partitions as it needs to fill the sample.  It is
    repeated, up to ``most_repeats`` times, until the dearest rule takes
    ``least_seconds`` more than no rule; of ``runs`` runs the fastest counts.
    """
    drawn = docs.select(text_of(text).alias("text")).sample(fraction=fraction, seed=seed).take(sample_rows)
    if not drawn:
        return [RuleCost(r, 0.0, 0.0) for r in rules]
    sample = docs.sparkSession.createDataFrame(drawn, "text string")
    rejects = [F.length("text") < 0, *[~keep_text(F.col("text"), [r]) for r in rules]]

    def measured(repeats: int, times: int) -> tuple[list[float], list[int]]:
        rows = sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("nth")) if repeats > 1 else sample
        took, found = [], []
        for c in rejects:
            probe, best = rows.agg(F.count_if(c).alias("n")), math.inf
            for _ in range(times):
                began = time.monotonic()
                n = probe.first()["n"]
                best = min(best, time.monotonic() - began)
            took.append(best)
            found.append(n)
        return took, found

    _, found = measured(1, 1)                       # compiles; these are the rejected rows
    repeats = 4
    took, _ = measured(repeats, 1)
    while max(took[1:], default=0.0) - took[0] < least_seconds and repeats < most_repeats:
        repeats *= 4
        took, _ = measured(repeats, 1)
    if runs > 1:
        again, _ = measured(repeats, runs - 1)
        took = [min(a, b) for a, b in zip(took, again)]
    rows = len(drawn) * repeats
    out = [RuleCost(r, max(t - took[0], 0.0) / rows, n / len(drawn)) for r, t, n in zip(rules, took[1:], found[1:])]
    return sorted(out, key=lambda c: -c.gain)


def keep(stats: FromParts | FromColumns, ordered: Sequence[Rule]) -> Column:
    """True where no rule rejects; later rules run only on rows that got so far."""
    c = F
    for r in ordered:
        c = c.when(r.rejects(stats), F.lit(False))
    return c.otherwise(F.lit(True)) if ordered else F.lit(True)


def keep_text(text: Column, ordered: Sequence[Rule]) -> Column:
    """:func:`keep` over a text that is split into words once."""
    return let(words_of(text), lambda w: keep(FromParts(Parts(text, w, worded_lines(text))), ordered))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """All statistics as columns (replacing columns of the same names)."""
    t = text_of(text)
    stats = let(words_of(t), lambda w: let(worded_lines(t), lambda x: F.struct(
        *[f(Parts(t, w, x)).alias(k) for k, f in FEATURES.items()])))
    return docs.withColumn("__stats", stats).withColumns({k: F.col(f"__stats.{k}") for k in FEATURES}).drop("__stats")


def quality_filter(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that pass every rule, with the columns they came with."""
    order = [c.rule for c in plan_cascade(docs, rules, text)]
    return docs.where(keep_text(text_of(text), order))
