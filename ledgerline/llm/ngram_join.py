"""Jaccard join of word n-gram sets: a prefix tree over globally ordered sets, and its components.

A text's set holds the 64-bit hashes (XXH64, seed 42) of its word shingles,
each once, ordered by hash: one global order.  Two sets are linked when
100 * intersection >= percent * union.  Equal sets are one node from here on.

Candidates.  Two linked sets of sizes s and t differ in at most
D = (100 - percent) * (s + t) / (100 + percent) n-grams, so if the n-grams are
dealt into D + 1 parts by their hash, one part at least is equal.  D follows
from a size class; a set is keyed in its own class and, where a smaller partner
may lie in it, in the class below.  A part of no or one n-gram would be equal in
many sets by chance, so it is no key; a set with such a part is keyed again
with the parts of another hash, and only after ``SEEDS`` hashes do all parts
count.  (If the equal parts of a pair are all that small, both sets are keyed
again, so no pair is lost.)  Sets with a common key are candidates, and so, in
turn, are theirs: the components of candidates are what a tree must hold.
Inside a batch a key is shuffled once, for the first set that has it; the
others are tied to that set on the spot, so a key of very many near copies
costs a row for each batch.

The tree.  The sets of a component are sorted as sequences; a range of sets
that share a prefix is a node of their prefix tree.  A query set walks down
the tree with the overlap so far, which all sets below a node share, and a
subtree is left as soon as the remaining lengths, of the query and of the
longest useful set below, cannot reach the overlap that a link needs.  It is
left as well when all its sets are known to be in the query's component.  The
queries of a block walk together, as numpy arrays.

Memory.  A task holds about ``budget`` n-grams.  A component above that is
solved in rounds: some of its sets (leaders, half a budget) are put before
every block of the others.  Then the leaders are done; what is left goes on
only while it has several components, and the next leaders come from all but
the largest of them.  So a huge group of near copies takes a pass or two, and
nothing is dropped in any case.

Defined cases: a text without words, or null, has an empty set and is linked
with nothing; fewer words than ``width`` are one shingle; rows are returned one
by one, repeated rows included; a null id joins its component but never names
it; an empty table gives an empty table.  Only the id and text columns are
read.  Two different n-grams, or sets, of equal 64-bit hash would be taken for
the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.batches import importable, map_batches, ragged, texts
from ledgerline.llm.common import written
from ledgerline.llm.components import components

SEED = 42
SEEDS = 4                 # hashes that deal n-grams into parts, before small parts count too
STEP = 64                 # n-grams of a single set looked up between two checks of its bound


def ngram_set(text: str, width: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    k = min(width, len(words))
    spans = zip((end - size)[:len(words) - k + 1].tolist(), end[k - 1:].tolist())
    of = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((of(joined[a:b], SEED) for a, b in spans), dtype=np.uint64))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


# -- candidates -------------------------------------------------------------------

def size_classes(largest: int, percent: int) -> np.ndarray:
    """First sizes of the classes: a set is linked within its class and the next one only."""
    first = [1]
    while first[-1] <= largest:
        first.append(100 * first[-1] // percent + 1)
    return np.array(first + [100 * first[-1] // percent + 1], dtype=np.int64)


def parts_of(classes: np.ndarray, percent: int) -> np.ndarray:
    """Parts by class: one more than n-grams in which two linked sets can differ, the smaller of them in that class."""
    top = classes[1:] - 1
    return (100 - percent) * (top + 100 * top // percent) // (100 + percent) + 1


def _sums(value: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit hashes by place, modulo 2^64."""
    low = np.bincount(at, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(at, (value >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
    with np.errstate(over="ignore"):
        return low + (high << np.uint64(32))


def part_keys(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(set number, key) of all sets; linked sets that are not equal share a key."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    classes = size_classes(int(size.max(initial=1)), percent)
    parts = parts_of(classes, percent)
    own = np.searchsorted(classes, size, "right") - 1
    below = (own > 0) & (percent * size <= 100 * (classes[np.maximum(own, 0)] - 1))
    owner, keys = [], []
    for scheme, live in ((own, size > 0), (own - 1, below)):
        todo = np.flatnonzero(live)
        todo = todo[parts[scheme[todo]] > 1]                                 # else only equal sets are linked
        for seed in range(SEEDS):
            if not len(todo):
                break
            k, c = parts[scheme[todo]], scheme[todo]
            flat = np.concatenate([sets[i] for i in todo])
            hashed = mixed(flat, seed + 1)
            first = np.cumsum(k) - k
            at = np.repeat(first, size[todo]) + (hashed % np.repeat(k, size[todo]).astype(np.uint64)).astype(np.int64)
            n = int(k.sum())
            many, total = np.bincount(at, minlength=n), _sums(mixed(hashed), at, n)
            of = np.repeat(np.arange(len(todo)), k)
            place = np.arange(n) - first[of]
            key = mixed(total + mixed(((c[of] << 40) | (place << 8) | seed).astype(np.uint64)))
            small = many < 2
            use = np.flatnonzero(~small) if seed < SEEDS - 1 else np.arange(n)
            owner.append(todo[of[use]])
            keys.append(key[use])
            todo = todo[np.bincount(of, small, len(todo)) > 0]
    if not owner:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    return np.concatenate(owner), np.concatenate(keys)


def keyed(docs: DataFrame, width: int, percent: int, id_col: str, text: str) -> DataFrame:
    """(id, text_hash, size, node, keys, ties) by row: node is the hash of the set, null for an empty one.

    ``keys`` are those that no earlier set of the batch has; ``ties`` are the
    nodes that have the others.
    """
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sets = [ngram_set(t, width) for t in texts(batch)]
        size = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets)
        total = _sums(mixed(flat), np.repeat(np.arange(len(sets)), size), len(sets))
        node = mixed(total + mixed(size.astype(np.uint64))).view(np.int64)
        owner, key = part_keys(sets, percent)
        order = np.lexsort((owner, key))
        owner, key = owner[order], key[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        lead = node[owner[np.flatnonzero(new)]][np.cumsum(new) - 1] if len(key) else key.view(np.int64)
        tied = np.unique(np.stack([owner, lead])[:, ~new & (lead != node[owner])], axis=1)
        back = np.argsort(owner[new], kind="stable")
        return {"size": pa.array(size), "node": pa.array(node, mask=size == 0),
                "keys": ragged(pa.array(key[new][back].view(np.int64)), np.bincount(owner[new], minlength=len(sets))),
                "ties": ragged(pa.array(tied[1]), np.bincount(tied[0], minlength=len(sets)))}

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return map_batches(rows, run, "size long, node long, keys array<long>, ties array<long>").drop("text")


def candidates(rows: DataFrame) -> DataFrame:
    """(node, root): the components of sets with common keys, of two sets at least."""
    by_key = rows.where("node is not null").select("node", F.explode("keys").alias("key"))
    before = by_key.select("node", F.lag("node").over(Window.partitionBy("key").orderBy("node")).alias("other"))
    tied = rows.select("node", F.explode("ties").alias("other"))
    return components(before.unionByName(tied).where("node != other").select(F.col("node").alias("a"),
                                                                             F.col("other").alias("b")))


# -- the tree -----------------------------------------------------------------------

class PrefixTree:
    """Sorted n-gram sets of some components; the nodes are ranges of sets that share a prefix.

    ``label`` holds what is known: sets of equal label are in one component.
    """

    def __init__(self, sets: list[np.ndarray], comp: np.ndarray, label: np.ndarray, percent: int):
        raw = [s.astype(">u8").tobytes() for s in sets]
        self.order = np.array(sorted(range(len(sets)), key=lambda i: (comp[i], raw[i])), dtype=np.int64)
        sets, comp = [sets[i] for i in self.order], comp[self.order]
        self.percent, self.n = percent, len(sets)
        self.label = np.unique(label[self.order], return_inverse=True)[1]
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.at = np.cumsum(self.size) - self.size
        values, self.rank = np.unique(np.concatenate(sets), return_inverse=True)
        self.unit = len(values)
        self.place = np.repeat(np.arange(self.n), self.size) * self.unit + self.rank      # ascending: set, then n-gram
        self.common = np.full(self.n, -1, dtype=np.int64)
        for i in range(1, self.n):
            if comp[i] == comp[i - 1]:
                m = min(len(sets[i]), len(sets[i - 1]))
                apart = sets[i][:m] != sets[i - 1][:m]
                self.common[i] = apart.argmax() if apart.any() else m
        first = np.flatnonzero(self.common < 0)
        which = np.searchsorted(first, np.arange(self.n), "right") - 1
        self.start, self.end = first[which], np.append(first[1:], self.n)[which]
        self.least, self.most = [self.size], [self.size]
        span = 1
        while 2 * span <= self.n:                                             # extremes of 2^k sets from each place on
            self.least.append(np.minimum(self.least[-1][:-span], self.least[-1][span:]))
            self.most.append(np.maximum(self.most[-1][:-span], self.most[-1][span:]))
            span *= 2

    def sizes(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest set of each range."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        least, most = np.empty(len(lo), dtype=np.int64), np.empty(len(lo), dtype=np.int64)
        for k in np.unique(level):
            m = level == k
            a, b = lo[m], hi[m] - (1 << int(k))
            least[m] = np.minimum(self.least[k][a], self.least[k][b])
            most[m] = np.maximum(self.most[k][a], self.most[k][b])
        return least, most

    def find(self, query: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the query holds the n-gram, and how many of its n-grams come up to it."""
        want = query * self.unit + gram
        pos = np.searchsorted(self.place, want)
        hit = self.place[np.minimum(pos, len(self.place) - 1)] == want
        return hit, pos - self.at[query] + hit

    def possible(self, query, least, most, depth, overlap, passed) -> np.ndarray:
        """Whether some size between ``least`` and ``most`` can still reach the overlap of a link."""
        left = self.size[query] - passed
        best = np.clip(left + depth, least, most)
        return (100 + self.percent) * (overlap + np.minimum(best - depth, left)) >= self.percent * (self.size[query] + best)

    def rest(self, query, other, depth, overlap) -> np.ndarray:
        """Whether the pairs are linked, given the overlap in the first ``depth`` n-grams of ``other``."""
        linked = np.zeros(len(query), dtype=bool)
        pair, depth, overlap = np.arange(len(query)), depth.copy(), overlap.copy()
        while len(pair):
            q, x = query[pair], other[pair]
            many = np.minimum(self.size[x] - depth, STEP)
            passed = np.zeros(len(pair), dtype=np.int64)
            some = many > 0
            if some.any():
                m = many[some]
                of = np.repeat(np.flatnonzero(some), m)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(m) - m, m)
                hit, upto = self.find(q[of], self.rank[self.at[x[of]] + depth[of] + nth])
                overlap[some] += np.add.reduceat(hit.astype(np.int64), np.cumsum(m) - m)
                passed[some] = upto[np.cumsum(m) - 1]
                depth = depth + many
            good = self.possible(q, self.size[x], self.size[x], depth, overlap, passed)
            done = depth >= self.size[x]
            exact = (100 + self.percent) * overlap >= self.percent * (self.size[q] + self.size[x])
            linked[pair[done & exact]] = True
            go = good & ~done
            pair, depth, overlap = pair[go], depth[go], overlap[go]
        return linked

    def walk(self, query: np.ndarray) -> np.ndarray:
        """Linked pairs (2 x n) of the queries with later sets, but for those known to be in one component."""
        out = []
        change = np.flatnonzero(np.append((self.label[1:] != self.label[:-1]) | (self.common[1:] < 0), True)) + 1
        uniform = change[np.searchsorted(change, np.arange(self.n), "right")]        # end of the run of equal labels
        lo, hi = query + 1, self.end[query]
        overlap, passed = np.zeros(len(query), dtype=np.int64), np.zeros(len(query), dtype=np.int64)
        d = 0
        starts = np.flatnonzero(self.common <= 0)
        live = lo < hi
        query, lo, hi, overlap, passed = (v[live] for v in (query, lo, hi, overlap, passed))
        while len(query):
            new = ~((self.label[lo] == self.label[query]) & (uniform[lo] >= hi))
            query, lo, hi, overlap, passed = (v[new] for v in (query, lo, hi, overlap, passed))
            one = hi - lo == 1                                                # one set below: looked up to its end
            if one.any():
                linked = self.rest(query[one], lo[one], np.full(int(one.sum()), d), overlap[one])
                out.append(np.stack([query[one][linked], lo[one][linked]]))
                query, lo, hi, overlap, passed = (v[~one] for v in (query, lo, hi, overlap, passed))
            over = self.size[lo] == d                                         # the first set may end at this node
            if over.any():
                linked = over & ((100 + self.percent) * overlap >= self.percent * (self.size[query] + self.size[lo]))
                out.append(np.stack([query[linked], lo[linked]]))
                lo = lo + over
            if not len(query):
                break
            a, b = np.searchsorted(starts, lo, "right"), np.searchsorted(starts, hi, "left")
            many = b - a + 1
            state = np.repeat(np.arange(len(lo)), many)
            nth = np.arange(len(state)) - np.repeat(np.cumsum(many) - many, many)
            last = len(starts) - 1
            child = np.where(nth == 0, lo[state], starts[np.minimum(a[state] + nth - 1, last)])
            until = np.where(nth == many[state] - 1, hi[state], starts[np.minimum(a[state] + nth, last)])
            q = query[state]
            hit, passed = self.find(q, self.rank[self.at[child] + d])
            overlap = overlap[state] + hit
            d += 1
            least, most = self.sizes(child, until)
            keep = self.possible(q, least, most, d, overlap, passed)
            query, lo, hi, overlap, passed = (v[keep] for v in (q, child, until, overlap, passed))
            starts = np.flatnonzero(self.common <= d)
        return np.concatenate(out, axis=1) if out else np.empty((2, 0), dtype=np.int64)

    def join(self, states: int) -> np.ndarray:
        """Labels of the sets, in the order given, after all links are followed.

        Queries come in waves of 1, 2, 4, ... sets of each component, so that a
        wave profits from what the last ones have joined.
        """
        many, nth = self.end - self.start, np.arange(self.n) - self.start
        wave = np.frexp((nth + 1).astype(np.float64))[1] - 1
        for w in range(int(wave.max(initial=-1)) + 1):
            these = np.flatnonzero(wave == w)
            block = np.cumsum(many[these]) // states
            for query in np.split(these, np.flatnonzero(np.diff(block)) + 1):
                a, b = self.label[self.walk(query)]
                while (a != b).any():                                         # the lesser label of each link wins
                    to = np.arange(self.label.max() + 1)
                    np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
                    while (to[to] != to).any():
                        to = to[to]
                    self.label, a, b = to[self.label], to[a], to[b]
        out = np.empty(self.n, dtype=np.int64)
        out[self.order] = self.label
        return out


def joiner(width: int, percent: int, states: int = 1 << 17):
    """A task: rows (node, root, label, text) to links (a, b) that span the components found."""
    def join(table: pa.Table) -> pa.Table:
        node, root, label = (table.column(c).to_numpy() for c in ("node", "root", "label"))
        node, rows = np.unique(node, return_index=True)
        text = table.column("text").take(pa.array(rows)).to_pylist()
        got = PrefixTree([ngram_set(t, width) for t in text], root[rows], label[rows], percent).join(states)
        least = np.full(got.max() + 1, len(node))
        np.minimum.at(least, got, np.arange(len(node)))
        to = node[least[got]]
        moved = to != node
        return pa.table({"a": node[moved], "b": to[moved]})
    return join


def tasks_of(sets: DataFrame, budget: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """(``sets`` with their task (bucket, block), the sets of large components that are not done after it).

    ``sets`` has node, root (candidate component), label (known component) and size.
    """
    half = max(budget // 2, 1)
    known = sets.groupBy("root", "label").agg(F.sum("size").alias("w"))
    roots = written(known.groupBy("root").agg(F.sum("w").alias("total"), F.max(F.struct("w", "label")).alias("top"),
                                              F.count("*").alias("labels")).where("labels > 1"), "roots")
    every = roots.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    rows = sets.join(roots, "root")
    large = F.col("total") > budget
    minor = (F.col("total") - F.col("top.w")).cast("double")
    picked = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 20)) < F.lit(half * float(1 << 20)) / minor
    rows = rows.withColumn("leads", large & (F.col("label") != F.col("top.label")) & picked)
    blocks = F.ceil(F.col("total") / half).cast("int")
    block = (F.when(~large, F.array(F.lit(-1)))
             .when(F.col("leads"), F.sequence(F.lit(0), blocks - 1))
             .otherwise(F.array(F.pmod(F.xxhash64("node", F.lit(-1 - turn)), blocks).cast("int"))))
    small = F.pmod(F.xxhash64("root"), F.lit(every // budget + 1))
    dealt = rows.withColumns({"bucket": F.when(large, F.col("root")).otherwise(small), "blocks": block})
    return dealt, rows.where(large & ~F.col("leads")).select(sets.columns)


def near_sets(docs: DataFrame, rows: DataFrame, width: int, percent: int, id_col: str, text: str,
              budget: int) -> DataFrame:
    """(node, root): components of linked sets, of two sets at least."""
    whole = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    nodes = (rows.where("node is not null").groupBy("node")
             .agg(F.max("size").alias("size"), F.min(whole).alias("place")))
    sets = written(nodes.join(candidates(rows), "node").withColumn("label", F.col("node")), "ngram-sets")
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    same = F.col("id").eqNullSafe(F.col("place.id")) & (F.col("text_hash") == F.col("place.text_hash"))
    links, turn = None, 0
    while not sets.isEmpty():
        dealt, after = tasks_of(sets, budget, turn)
        bodies = (own.join(dealt.select("node", "root", "label", "bucket", "blocks", "place"), same)
                  .dropDuplicates(["node"]).select("node", "root", "label", "text", "bucket",
                                                   F.explode("blocks").alias("block")))
        found = written(bodies.groupBy("bucket", "block").applyInArrow(joiner(width, percent), "a long, b long"),
                        "ngram-links")
        links = found if links is None else links.unionByName(found)
        after = written(after, "ngram-sets")
        if after.isEmpty():
            break
        joined = written(components(links).select("node", F.col("root").alias("now")), "ngram-labels")
        sets = written(after.join(joined, "node", "left").withColumn("label", F.coalesce("now", "label")).drop("now"),
                       "ngram-sets")
        turn += 1
    if links is None:
        return sets.select("node", "root")
    return components(links)


def join(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text",
         budget: int = 1 << 21) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``; component_id is the least id reachable by links."""
    importable(docs.sparkSession)
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    rows = written(keyed(docs, width, percent, id_col, text), "ngram-keys")
    roots = written(near_sets(docs, rows, width, percent, id_col, text, budget), "ngram-roots")
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    grouped = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = written(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "ngram-names")
    named = written(grouped.join(names, "root").select("node", "component_id"), "ngram-named")
    return (rows.join(named, "node", "left")
            .select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
