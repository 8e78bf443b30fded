"""Secret scan with corpus-wide ownership frequency [native].

Patterns find candidate spans in each text.  Every candidate value is hashed,
and over the whole corpus the distinct owners and repositories of each hash are
counted.  Owners decide: a value that several owners hold is a copied example,
any other that looks random is taken for live.  Many repositories of one owner
are no excuse but a wider leak, so live values in many of them are counted
apart.  The count groups by (hash, owner, repository) first, then (hash,
owner), then hash, with partial sums at each step, so a value that a third of
all rows hold is counted on many tasks, and the tables that are joined are
written before, so that a hot side of a join can be split.

Offsets without Python: the matches of a pattern and the pieces between them
(``split`` by the same pattern) give each match's place by adding up lengths,
in chunks of about the root of their number, since growing one array match by
match would copy it each time.

Defined cases: a null text is an empty text; a null owner or repository counts
as one owner or repository; rows with the same id and text get the same result,
each of them; extra columns are ignored; an empty table gives an empty table.
Offsets are code points, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, let, text_of, written

_ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
           r"([A-Za-z0-9+/_.=-]+)")

_KEY = r"[A-Z0-9 ]{0,40}PRIVATE KEY-----"
_BODY = r"[^-]*+(?:-(?!----)[^-]*+)*+"                      # all up to five dashes
_BODY_CUT = r"(?:\s++[A-Za-z0-9+/=]{40,}+)*+"               # of a key without its END line; empty if only named


@dataclass(frozen=True)
class Kind:
    """``value`` is the group that holds the secret; matches whose value is shorter than ``least`` are dropped."""
    name: str
    pattern: str
    value: int = 0
    least: int = 1


BASE = (
    Kind("assign", _ASSIGN, 1, 6),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),      # whole runs; shorter runs would be dropped anyway
)
ADDED = (
    Kind("private_key", rf"-----BEGIN {_KEY}({_BODY}(?=-----END {_KEY})|{_BODY_CUT})(?:-----END {_KEY})?+", 1, 0),
    Kind("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Kind("web_token", r"eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
    Kind("url_login", r"(?<![a-z])[a-z]{2,12}+://[^\s:/@]++:([^\s:/@]{3,}+)@", 1),
)
KINDS = BASE + ADDED
PLACEHOLDER = r"(?i)example|changeme|dummy|sample|placeholder|xxxx|your[_-]?|12345"


def _spans(text: Column, order: int, kind: Kind) -> Column:
    """Leftmost non-overlapping matches as structs (start, order, kind, end, value)."""
    pattern = F.lit(kind.pattern)
    none = F.expr("CAST(array() AS array<struct<start:bigint,order:int,kind:string,end:bigint,value:string>>)")

    def one(start: Column, m: Column) -> Column:
        value = F.regexp_extract(m, kind.pattern, kind.value) if kind.value else m
        return F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(kind.name).alias("kind"),
                        (start + F.length(m)).alias("end"), value.alias("value"))

    def place(found: Column) -> Column:
        between = F.transform(F.split(text, kind.pattern, -1), lambda p: F.length(p).cast("long"))
        steps = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("m"))
        chunk = F.ceil(F.sqrt(F.size(found))).cast("int")

        def begin(at: Column, empty: Column) -> Column:
            return F.struct(at.cast("long").alias("at"), empty.alias("out"))

        def add(acc, s):
            start = acc["at"] + s["gap"]
            return F.struct((start + F.length(s["m"])).alias("at"),
                            F.concat(acc["out"], F.array(one(start, s["m"]))).alias("out"))

        def chunks(all_steps: Column) -> Column:
            def whole(acc, k):
                done = F.aggregate(F.slice(all_steps, k + 1, chunk), begin(acc["at"], none), add)
                return let(done, lambda d: F.struct(d["at"].alias("at"),
                                                    F.concat(acc["out"], F.array(d["out"])).alias("out")))
            return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1, chunk), begin(F.lit(0), F.array_remove(
                F.array(none), none)), whole, lambda acc: F.flatten(acc["out"]))
        return let(steps, chunks)

    placed = let(F.regexp_extract_all(text, pattern, F.lit(0)),
                 lambda found: F.when(F.size(found) == 0, none).otherwise(place(found)))
    return F.filter(placed, lambda s: F.length(s["value"]) >= kind.least)


def find(text: Column) -> Column:
    """All spans of a text by start, then kind as listed."""
    return F.sort_array(F.concat(*[_spans(text, i, k) for i, k in enumerate(KINDS)]))


def looks_random(value: Column) -> Column:
    """Long enough, varied, with digits, and no placeholder words."""
    kinds = F.size(F.array_distinct(F.split(value, "")))
    return ((F.length(value) >= 16) & (kinds >= 8) & value.rlike("[0-9]") & ~value.rlike(PLACEHOLDER))


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each candidate hash (h1, h2) of ``found`` (h1, h2, owner, repo)."""
    held = found.groupBy("h1", "h2", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = held.groupBy("h1", "h2", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("h1", "h2").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id",
         common_owners: int = 3, classify: Callable[[Column], Column] = looks_random,
         spread_repos: int = 10) -> DataFrame:
    """One row per row of ``docs``: id, spans (with hashes, n_owners and n_repos), n_live, n_spread, n_example.

    A value held by ``common_owners`` owners or more is an example: two may be
    an owner and a mirror or fork of theirs, three have copied it from
    elsewhere.  Any other value is live if ``classify`` finds it random, and
    spread if ``spread_repos`` repositories or more hold it.  Where the table
    has no repositories, each document stands for one.  Values themselves are
    not returned.
    """
    t = text_of(text)
    hashed = F.transform("spans", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.xxhash64(s["value"]).alias("h1"), F.xxhash64(F.lit("secret"), s["value"]).alias("h2"),
        classify(s["value"]).alias("random")))
    rows = cut(docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("text_hash"), F.col(owner).alias("owner"),
                           F.col(repo).alias("repo"), find(t).alias("spans"))
               .withColumn("spans", hashed))
    each = rows.select("id", "text_hash", "owner", "repo", F.posexplode("spans").alias("nth", "s")).select(
        "id", "text_hash", "owner", "repo", "nth", "s.*")
    counts = written(ownership(each), "secret-owners")
    places = written(each.groupBy("id", "text_hash", "nth", "h1", "h2").agg(F.max("random").alias("random")),
                     "secret-places")
    judged = places.join(counts, ["h1", "h2"])
    example = F.col("n_owners") >= common_owners
    live = ~example & F.col("random")
    verdict = written(judged.groupBy("id", "text_hash").agg(
        F.count_if(live).alias("n_live"), F.count_if(live & (F.col("n_repos") >= spread_repos)).alias("n_spread"),
        F.count_if(example).alias("n_example"),
        F.sort_array(F.collect_list(F.struct("nth", "n_owners", "n_repos"))).alias("__held")), "secret-verdicts")

    def counted(s: Column, nth: Column) -> Column:
        held = F.get("__held", nth)
        return s.withField("n_owners", held["n_owners"]).withField("n_repos", held["n_repos"])

    v = verdict.withColumnsRenamed({"id": "__id", "text_hash": "__hash"})
    return (rows.join(v, F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
            .select(F.col("id").alias(id_col), F.transform("spans", counted).alias("spans"),
                    *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_live", "n_spread", "n_example")]))
