"""Spelling variants: words one edit apart, found by dynamic programming over sorted word lists.

Words are counted over whole texts.  Two words are near if they differ by one
inserted, deleted or replaced code point; a word's form is its most frequent
near word, if that is ``ratio`` times as frequent, and its root is the end of
the chain of forms.

The search scans sorted lists.  The edit matrix between a query word and a
list word has one row per code point of the list word, and only the three
cells around the diagonal can hold a distance of one.  The rows of a list
word's first k code points are those of every list word with the same first k,
so each row is computed once for the whole range of words that share it (the
ranges follow from the longest common prefixes of adjacent words), and a range
whose row exceeds one edit is skipped.  The queries of a list advance through
it together, one code point at a time, as numpy arrays.

Lists are kept small without losing a pair.  Let m be the length of the
shorter word of a pair and e the place of the first difference.  If e lies in
[a, b), both words share their first a and their last m - b code points, so the
pair meets in the list of that window, m, prefix and suffix.  Every word starts
in two windows that cover all places, for itself as the shorter and as the
longer word.  A list of more than ``most`` words is split by halving its
window, round by round; a window of one place holds words that are equal but
for two code points, at most.  A pair is reported by the one list whose window
has its first difference.

Lists are dealt to tasks in buckets of about ``bucket`` rows.  Occurrences are
added up inside each task before they are shuffled, so a frequent word costs a
row per task.

Defined cases: a null text has no words; a null id counts as an empty one in
the deletion rule; repeated rows count again; words of any length are compared
whole; without words the result is empty.  Only the id and text columns are
read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.batches import importable, slices, texts
from ledgerline.llm.common import cut, written

LETTERS = "a-zÀ-ÿ"       # runs after A-Z are lower-cased
KEPT_WORDS = 1 << 18               # counted words a task holds before it hands them on


# -- words and their counts -----------------------------------------------------

def occurrences(key, text: str, runs: re.Pattern, least: int, every: int) -> Iterator[tuple[str, int]]:
    """(word, times) of one text, with one code point deleted where the checksum of id and run says so."""
    seed = zlib.crc32(f"{'' if key is None else key}:".encode())
    for run, n in Counter(runs.findall(text.encode().lower().decode())).items():
        h = zlib.crc32(run.encode(), seed)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        yield run, n


def count_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 6, times: int = 5,
                every: int = 199) -> DataFrame:
    """(word, n): words of at least ``least`` code points and ``times`` occurrences."""
    importable(docs.sparkSession)
    runs = re.compile(f"[{LETTERS}]{{{least},}}")                 # a match is a whole run: shorter runs match nowhere

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])
        for batch in batches:
            for part in slices(batch, "text"):
                for key, t in zip(part.column("id").to_pylist(), texts(part)):
                    for word, n in occurrences(key, t, runs, least, every):
                        held[word] += n
                    if len(held) > KEPT_WORDS:
                        yield out()
                        held.clear()
        yield out()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


# -- the scan ---------------------------------------------------------------------

class WordList:
    """Sorted words as code points, with the longest common prefixes of neighbours.

    ``group`` numbers the list of each word; words of one list share ``depth``
    code points and stand together, in code-point order.
    """

    def __init__(self, words: list[str], group: np.ndarray, depth: np.ndarray):
        self.size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.code = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        self.at = np.cumsum(self.size) - self.size
        self.depth = depth
        common = np.zeros(len(words), dtype=np.int64)
        live = np.flatnonzero(group[1:] == group[:-1]) + 1
        k = 0
        while len(live):                                          # neighbours that share k code points
            live = live[(self.size[live] > k) & (self.size[live - 1] > k)]
            live = live[self.code[self.at[live] + k] == self.code[self.at[live - 1] + k]]
            k += 1
            common[live] = k
        # a list ends where the next one starts, or where unequal keys shared a hash
        first = np.ones(len(words), dtype=bool)
        first[1:] = (group[1:] != group[:-1]) | (common[1:] < depth[1:])
        self.common = np.where(first, -1, common)
        self.start = np.flatnonzero(first)
        self.end = np.append(self.start[1:], len(words))
        self.list_of = np.cumsum(first) - 1

    def char(self, word: np.ndarray, k) -> np.ndarray:
        """Code point ``k`` of each word, 0 beyond its end."""
        inside = (k >= 0) & (k < self.size[word])
        return np.where(inside, self.code[np.where(inside, self.at[word] + k, 0)], 0)


def _scan(lists: WordList, query: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: int) -> list[np.ndarray]:
    """Pairs (query, later word) within one edit, for queries of lists that share ``d`` code points.

    A state is a query and a range of its list that shares ``d`` code points,
    with the three cells of the row of that prefix: columns d-1, d and d+1.
    """
    out = []
    below = np.full(len(query), 1 if d else 2, dtype=np.int8)
    here, above = np.zeros(len(query), dtype=np.int8), np.ones(len(query), dtype=np.int8)
    starts = np.flatnonzero(lists.common <= d)
    while len(query):
        # the word that ends here is the first of its range
        ends = (lists.size[lo] == d) & (lo > query)
        beyond = lists.size[query] - d
        row = np.where(beyond == 0, here, np.where(beyond == 1, above, np.where(beyond == -1, below, 2)))
        hit = ends & (row <= 1)
        if hit.any():
            out.append(np.stack([query[hit], lo[hit]]))
        # the ranges that share one code point more
        lo = lo + (lists.size[lo] == d)
        rest = lo < hi
        query, lo, hi, below, here, above = (x[rest] for x in (query, lo, hi, below, here, above))
        if not len(query):
            break
        a, b = np.searchsorted(starts, lo, "right"), np.searchsorted(starts, hi, "left")
        many = b - a + 1                                          # the range at lo, and one for each start inside
        state = np.repeat(np.arange(len(lo)), many)
        nth = np.arange(len(state)) - np.repeat(np.cumsum(many) - many, many)
        child = np.where(nth == 0, lo[state], starts[np.minimum(a[state] + nth - 1, len(starts) - 1)])
        until = np.where(nth == many[state] - 1, hi[state], starts[np.minimum(a[state] + nth, len(starts) - 1)])
        keep = until > query[state] + 1                           # only words after the query
        state, child, until = state[keep], child[keep], until[keep]
        q, c = query[state], lists.char(child, d)
        p, h, u = below[state], here[state], above[state]
        new_below = np.minimum(p + (c != lists.char(q, d - 1)), h + 1)
        new_here = np.minimum(np.minimum(h + (c != lists.char(q, d)), u + 1), new_below + 1)
        new_above = np.minimum(u + (c != lists.char(q, d + 1)), new_here + 1)
        near = np.minimum(np.minimum(new_below, new_here), new_above) <= 1       # else the whole range is skipped
        query, lo, hi = q[near], child[near], until[near]
        below, here, above = (x[near].astype(np.int8) for x in (new_below, new_here, new_above))
        d += 1
        starts = np.flatnonzero(lists.common <= d)
    return out


def pairs_within(lists: WordList, states: int = 1 << 18) -> np.ndarray:
    """All pairs (2 x n) of words of one list that are one edit apart, the earlier word first.

    Queries go in blocks whose lists hold ``states`` words, which bounds the
    number of ranges that are looked at together.
    """
    out = []
    many = lists.end - lists.start
    query = np.arange(len(lists.size))
    query = query[many[lists.list_of] > 1]
    for d in np.unique(lists.depth[query]):
        these = query[lists.depth[query] == d]
        block = np.cumsum(many[lists.list_of[these]]) // states
        for part in np.split(these, np.flatnonzero(np.diff(block)) + 1):
            which = lists.list_of[part]
            out += _scan(lists, part, lists.start[which], lists.end[which], int(d))
    return np.concatenate(out, axis=1) if out else np.empty((2, 0), dtype=np.int64)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def near_in(table: pa.Table) -> pa.Table:
    """Both directions of the near pairs of a bucket of rows (word, n, key, m, a, b)."""
    word = table.column("word").to_pylist()
    key, m, a, b = (table.column(c).to_numpy().tolist() for c in ("key", "m", "a", "b"))
    order = sorted(range(len(word)), key=lambda i: (key[i], m[i], a[i], b[i], word[i]))
    rank = {}
    group = np.array([rank.setdefault((key[i], m[i], a[i], b[i]), len(rank)) for i in order], dtype=np.int64)
    words = [word[i] for i in order]
    x, y = pairs_within(WordList(words, group, np.array([a[i] for i in order], dtype=np.int64))).tolist()
    mine = [(i, j) for i, j in zip(x, y)
            if min(len(words[i]), len(words[j])) == m[order[i]]
            and a[order[i]] <= _common(words[i], words[j]) < b[order[i]]]
    n = table.column("n").to_numpy()
    left, right = [i for i, _ in mine] + [j for _, j in mine], [j for _, j in mine] + [i for i, _ in mine]
    return pa.table({"word": pa.array([words[i] for i in left], pa.string()),
                     "near": pa.array([words[j] for j in right], pa.string()),
                     "near_n": pa.array([int(n[order[j]]) for j in right], pa.int64())})


# -- lists of the corpus ------------------------------------------------------------

def _key() -> Column:
    """The 64-bit key of a row's window: what all words of a list share."""
    word = F.col("word")
    prefix = word.substr(F.lit(1), F.col("a"))
    suffix = word.substr(F.length(word) - (F.col("m") - F.col("b")) + 1, F.greatest(F.col("m") - F.col("b"), F.lit(0)))
    return F.xxhash64("m", "a", "b", prefix, suffix)


def lists_of(words: DataFrame, least: int = 6, most: int = 8192) -> DataFrame:
    """(word, n, m, a, b, key): the lists that each word stands in, none over ``most`` words but in windows of one place."""
    size = F.length("word")

    def windows(m: Column) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        return [F.struct(m.alias("m"), F.lit(0).alias("a"), half.alias("b")),
                F.struct(m.alias("m"), half.alias("a"), (m + 1).alias("b"))]
    as_shorter, as_longer = F.array(*windows(size)), F.array(*windows(size - 1))
    both = F.when(size > least, F.concat(as_shorter, as_longer)).otherwise(as_shorter)
    todo = words.select("word", "n", F.inline(both)).withColumn("key", _key())
    done = None
    while True:
        todo = written(todo, "word-lists")
        large = written(todo.groupBy("key", "m", "a", "b").count()
                        .where((F.col("count") > most) & (F.col("b") - F.col("a") > 1)).drop("count"), "large-lists")
        if large.isEmpty():
            return todo if done is None else done.unionByName(todo)
        names = ["key", "m", "a", "b"]
        kept = todo.join(large, names, "left_anti").select(todo.columns)
        done = kept if done is None else done.unionByName(kept)
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        halves = F.explode(F.array(F.struct(F.col("a").alias("a"), middle.alias("b")),
                                   F.struct(middle.alias("a"), F.col("b").alias("b"))))
        todo = (todo.join(large, names, "left_semi").select("word", "n", "m", halves.alias("w"))
                .select("word", "n", "m", "w.a", "w.b").withColumn("key", _key()).select(todo.columns))


def near_pairs(words: DataFrame, least: int = 6, most: int = 8192, bucket: int = 1 << 16) -> DataFrame:
    """(word, near, near_n): every ordered pair of words of ``words`` (word, n) one edit apart."""
    importable(words.sparkSession)
    rows = lists_of(words, least, most)
    buckets = rows.count() // bucket + 1
    return (rows.withColumn("bucket", F.pmod("key", F.lit(buckets)))
            .groupBy("bucket").applyInArrow(near_in, "word string, near string, near_n long"))


def roots(forms: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(word, root) for every word of ``forms`` (word, form): the end of its chain, by pointer doubling."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(max_rounds):
        step = written(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "forms")
        ahead = now.join(step, "root", "left")
        now = cut(ahead.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")
    raise RuntimeError(f"chains of forms did not end in {max_rounds} rounds")


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 6, times: int = 5,
             every: int = 199, ratio: int = 5, **search) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of the corpus."""
    words = written(count_words(docs, id_col, text, least, times, every), "words")
    found = near_pairs(words, least, **search)
    best = F.min(F.struct((-F.col("near_n")).alias("least_n"), F.col("near").alias("near")))     # ties: the smallest word
    near = found.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.least_n") >= ratio * F.col("n")
    rows = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.least_n")).alias("form_n")), "variants")
    ends = written(roots(rows.where("form is not null").select("word", "form")), "roots")
    return rows.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
