"""Fuzzy de-duplication of new entities against the main tables.

The reference scores every (source, main) pair that shares a tax id.  Here
candidate pairs come from an exact similarity join instead, so a block only
expands into the pairs that share a positioned name segment:

* the name score is ``1 - lev(src, main) / len(src)``; a pair can reach the
  threshold ``t`` only when ``lev <= k = floor((1 - t) * len(src))``;
* pigeonhole: cut the source name into up to ``2 (k + 1)`` segments; ``k``
  edits touch at most ``k`` of them, so of *any* ``k + 1`` segments one stands
  unchanged in a main name within ``k`` edits, at a place whose shift is
  bounded (position-aware substrings, Li et al., VLDB 2011);
* rare first: the main side's substrings are counted by (block, length,
  segment number, text), which is exactly what joining on a segment would
  cost, and each source name joins on its ``k + 1`` rarest segments only.  A
  prefix that all names of a block share is thus never joined on, unless a
  name has nothing rarer to show;
* both sides carry their names, so a candidate is verified with the exact
  score where it is found, and a pair that passes is emitted only at the first
  chosen segment that it has in common (long segments, below: made distinct
  when it passes): there is no candidate table to de-duplicate.  Addresses are fetched for passing pairs alone.

Short segments of short names are common, and more so the larger a block is.
Names that allow one or two edits (:data:`NEAR_EDITS`) are therefore cut into
``floor(k / 2) + 1`` long segments instead, one of which has at most one edit:
it shares a text of all its letters but one with the main name's window at one
of its places (a character of padding stands in for a letter that is missing
at the end).  Where a half of the names is :data:`COMMON` in a block, its names
keep to the rare segments.

Names of three to :data:`FAR_EDITS` edits are joined on long segments, too, in
blocks of more than :data:`COMMON` main names of one length (in a smaller one
the rare segments lead to few pairs).  Equal segments would be no use there: a
prefix that all names share may fill one.  They are cut where the main names
differ instead: each position weighs as much as its letters tell names apart,
each segment holds the same weight, and positions that tell nothing are left
out at its ends, which pigeonhole allows.  If :data:`COMMON` names still share
a segment, the block keeps to the rare ones.  The texts are joined by a hash;
a collision costs a candidate.

The names, and the substrings and their counts, are written to the shared
folder, so they are made once and each side of the joins has an exchange of
its own.  Blank
blocking values never match (a NULL tax id turned into ``''`` would otherwise
put all of them in one block).  A hot block or a segment text shared by very
many names is an equi-join hot key, which AQE's skew-join handling splits
across tasks.  Candidates still grow with the square of a block whose names
differ in so few letters that most of its pairs pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.dedupe import latest
from ledgerline.session import scratch_path

# Default duplicate threshold on the name score.
NAME_THRESHOLD = 0.8
# Identifier type holding the tax id, and address separator.
TAX_TYPE = "tax_id"
ADDRESS_SEPARATOR = ":"
# Routing outcomes.
ROUTE_UPDATE_KNOWN, ROUTE_UPDATE_MATCHED, ROUTE_INSERT = "update_known", "update_matched", "insert"

# Names of at most so many edits are joined on long segments with an edit, unless more main names of
# a block have the same half; and the character behind the end of a main name (in a name it costs candidates only).
NEAR_EDITS, COMMON, PAD = 2, 1000, "\u0001"
# Names of more, but at most so many edits are joined on long segments in large blocks, cut at positions
# of at least so many bits.
FAR_EDITS, BITS = 5, 0.1

_EPS = 1e-9


def _max_edits(n: Column, t: float) -> Column:
    return F.floor((F.lit(1.0) - F.lit(t)) * n + F.lit(_EPS)).cast("int")


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def match_profile(details: DataFrame, identifiers: DataFrame, addresses: DataFrame,
                  entity: str = "business_entity_id", name: str = "business_entity_name",
                  tax_type: str = TAX_TYPE,
                  address_lines: Sequence[str] = ("street_line_1", "street_line_2", "street_line_3",
                                                  "city", "state_province", "country")) -> DataFrame:
    """Entity + tax id + address.

    Identifiers are filtered to the tax type *before* the join; the address
    lines are ``:``-joined; NULL text becomes ``''`` as in the reference.  An
    entity with several names, tax ids or addresses has a row for each.
    """
    tax = identifiers.filter(F.col("identifier_type") == tax_type).select(
        F.col("related_identifier").alias(entity), F.col("identifier_value").alias("tax_id")).distinct()
    lines = [c for c in address_lines if c in addresses.columns]
    addr = addresses.select(F.col("related_identifier").alias(entity),
                            F.concat_ws(ADDRESS_SEPARATOR, *[F.coalesce(F.col(c), F.lit("")) for c in lines])
                            .alias("address"), F.col("postal_code")).distinct()
    prof = details.select(entity, F.col(name).alias("name")).join(tax, entity, "left").join(addr, entity, "left")
    return prof.select(entity, *[F.coalesce(F.col(c), F.lit("")).alias(c)
                                 for c in ("name", "tax_id", "address", "postal_code")])


def _cut(df: DataFrame, near: bool) -> DataFrame:
    """The number of segments (``_p``) of names of length ``_n``: twice as many as must be looked at, as far as
    there are letters; or the few of which one has at most one edit."""
    n, k = F.col("_n"), F.col("_k")
    parts = F.floor(k / 2).cast("int") + 1 if near else F.least(n, 2 * (k + 1))
    return df.withColumn("_p", parts).withColumn("_near", F.lit(near))


def _start(i: Column) -> Column:
    """First place of segment i of the source name."""
    return F.floor(i * F.col("_n") / F.col("_p")).cast("int")


def _size(i: Column) -> Column:
    return _start(i + 1) - _start(i)


def _places(i: Column) -> tuple[Column, Column]:
    """Where segment i can stand in a main name within k edits: edits before it shift it, edits behind make up the length.
    A segment with an edit may lack its last letter."""
    n, k, m = F.col("_n"), F.col("_k"), F.col("_m")
    low = F.greatest(F.lit(0), _start(i) - F.floor((k - (m - n)) / 2).cast("int"))
    high = F.least(m - _size(i) + F.col("_near").cast("int"), _start(i) + F.floor((k + (m - n)) / 2).cast("int"))
    return low, high


def _but_one(name: str) -> Column:
    """The texts of ``_len`` letters of a name from place ``_at`` without one of them."""
    text, at, size = F.col(name), F.col("_at"), F.col("_len")
    return F.array_distinct(F.transform(F.sequence(F.lit(1), size), lambda q: F.concat(
        F.substring(text, at + 1, q - 1), F.substring(text, at + q + 1, size - q))))


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _lengths(R: DataFrame, L: DataFrame, t: float) -> DataFrame:
    """Main names with each source length they can be near to."""
    m = F.col("_m")
    # plausible source lengths n: |m - n| <= k(n); k(n) <= (1 - t) n bounds the range
    lo = F.greatest(F.lit(1), F.floor(m / (2 - t)).cast("int") - 1)
    hi = F.ceil(m / t).cast("int") + 1
    return (R.select("*", F.explode(F.sequence(lo, hi)).alias("_n"))
            .withColumn("_k", _max_edits(F.col("_n"), t))
            .filter(F.abs(m - F.col("_n")) <= F.col("_k"))
            .join(L.select("_n").distinct(), "_n", "left_semi"))   # tiny in practice; AQE broadcasts it from its measured size


def _each(df: DataFrame) -> DataFrame:
    each = df.select("*", F.explode(F.sequence(F.lit(0), F.col("_p") - 1)).alias("_i"))
    return each.withColumn("_at", _start(F.col("_i"))).withColumn("_len", _size(F.col("_i")))


_KEY = ["_b", "_n", "_i", "_seg"]
_SOURCE = ["_lk", "_b", "_ln", "_n", "_k", "_p", "_near", "_chosen"]


def _rare_candidates(L: DataFrame, R: DataFrame, t: float) -> DataFrame:
    """Pairs that share one of the ``k + 1`` rarest segments unchanged."""
    k, i = F.col("_k"), F.col("_i")
    low, high = _places(i)
    texts = F.array_distinct(F.transform(F.sequence(low, high), lambda p: F.substring(F.col("_rn"), p + 1, _size(i))))
    Rsub = _saved(_each(_cut(_lengths(R, L, t), False)).filter(low <= high)
                  .select("_rk", "_b", "_rn", "_m", "_n", "_i", F.explode(texts).alias("_seg")), "match-substrings")
    cost = _saved(Rsub.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_cost")), "match-costs")

    Lseg = (_each(_cut(L, False)).withColumn("_seg", F.substring("_ln", _start(i) + 1, _size(i))).join(cost, _KEY, "left"))
    ranked = F.sort_array(F.collect_list(F.struct(F.coalesce("_cost", F.lit(0).cast("long")).alias("c"), "_i", "_seg")))
    rarest = (Lseg.groupBy("_lk", "_b", "_ln", "_n", "_k", "_p", "_near").agg(ranked.alias("_r"))  # a name has few segments
              .withColumn("_r", F.slice("_r", F.lit(1), k + 1)).withColumn("_chosen", F.col("_r._i")))
    chosen = (rarest.select(*_SOURCE, F.explode("_r").alias("_s"))
              .filter("_s.c > 0").select(*_SOURCE, "_s._i", "_s._seg"))
    return chosen.join(Rsub, _KEY)


def _near_candidates(L: DataFrame, R: DataFrame, t: float) -> DataFrame:
    """Pairs that share all letters but one of a long segment; ``_chosen`` are all segments."""
    low, high = _places(F.col("_i"))
    main = (_each(_cut(_lengths(R, L, t), True)).filter(low <= high)
            .select("_rk", "_b", F.concat("_rn", F.lit(PAD)).alias("_padded"), "_rn", "_m", "_n", "_i", "_len",
                    F.explode(F.sequence(low, high)).alias("_at"))
            .select("_rk", "_b", "_rn", "_m", "_n", "_i", F.explode(_but_one("_padded")).alias("_seg")))
    source = (_each(_cut(L, True).withColumn("_chosen", F.sequence(F.lit(0), F.col("_p") - 1)))
              .select(*_SOURCE, "_i", F.explode(_but_one("_ln")).alias("_seg")))
    return source.hint("merge").join(main, _KEY)   # far more rows than the files they are made of let expect


def _cuts(R: DataFrame, t: float) -> DataFrame:
    """Segments (``_segs``: number, place, length) by block and length, where a block has many main names of a length
    and few of them share a segment."""
    names = _saved(R.select("_b", F.col("_m").alias("_n"), "_rn").distinct(), "match-names")
    k = _max_edits(F.col("_n"), t)
    large = (names.groupBy("_b", "_n").agg(F.count(F.lit(1)).alias("_c"))
             .filter((F.col("_c") > COMMON) & k.between(NEAR_EDITS + 1, FAR_EDITS)).select("_b", "_n"))
    names = names.join(large, ["_b", "_n"])
    letters = (names.select("_b", "_n", "_rn", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_at"))
               .groupBy("_b", "_n", "_at", F.substring("_rn", F.col("_at") + 1, F.lit(1)).alias("_x"))
               .agg(F.count(F.lit(1)).cast("double").alias("_c")))
    # bits by which a position tells two names apart
    weights = letters.groupBy("_b", "_n", "_at").agg(
        F.greatest(F.lit(0.0), 2 * F.log2(F.sum("_c")) - F.log2(F.sum(F.col("_c") * F.col("_c")))).alias("_w"))
    whole = Window.partitionBy("_b", "_n")
    so_far = whole.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = F.floor(k / 2) + 1
    share = (F.sum("_w").over(so_far) - F.col("_w") / 2) / F.sum("_w").over(whole)
    segs = (weights.filter(F.col("_w") >= BITS)
            .select("_b", "_n", "_at", F.least(F.floor(p * share), p - 1).cast("int").alias("_i"))
            .groupBy("_b", "_n", "_i").agg(F.min("_at").alias("_from"), (F.max("_at") - F.min("_at") + 1).alias("_len")))
    cuts = (segs.groupBy("_b", "_n").agg(F.sort_array(F.collect_list(F.struct("_i", "_from", "_len"))).alias("_segs"))
            .filter(F.size("_segs") == p))
    cuts = _saved(cuts, "match-cuts")
    shared = (names.join(cuts, ["_b", "_n"]).select("_b", "_n", "_rn", F.inline("_segs"))
              .groupBy("_b", "_n", "_i", F.substring("_rn", F.col("_from") + 1, F.col("_len")).alias("_x"))
              .agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > COMMON).select("_b", "_n"))
    return cuts.join(shared, ["_b", "_n"], "left_anti")


def _far_candidates(L: DataFrame, R: DataFrame, t: float) -> DataFrame:
    """Pairs that share all letters but one of a segment of ``_segs``, once for each text, or for each segment that
    stands unchanged in the main name."""
    n, k, m, i, start, size = (F.col(c) for c in ("_n", "_k", "_m", "_i", "_from", "_len"))
    # of the segments and what stands before them, take the first that, with those before it, has at most 2 i + 1 edits:
    # it has at most one, there are at least 2 i before it, so at most k - 2 i from its start on
    low = F.greatest(F.lit(0), start - F.least(2 * i + 1, F.floor((k - (m - n)) / 2).cast("int")),
                     start + (m - n) - (k - 2 * i))
    high = F.least(m - size + 1, start + F.least(2 * i + 1, F.floor((k + (m - n)) / 2).cast("int")),
                   start + (m - n) + (k - 2 * i))

    def hashed(name):
        text = F.col(name)
        return F.array_distinct(F.transform(F.sequence(F.lit(1), size), lambda q: F.xxhash64(
            "_b", "_n", "_i", F.concat(F.substring(text, F.col("_at") + 1, q - 1),
                                       F.substring(text, F.col("_at") + q + 1, size - q)))))

    cuts = L.select("_b", "_n", "_segs").distinct()
    main = (_lengths(R, L, t).join(cuts, ["_b", "_n"]).select("*", F.inline("_segs")).filter(low <= high)
            .select("_rk", "_b", "_rn", F.concat("_rn", F.lit(PAD)).alias("_padded"), "_n", "_i", "_len",
                    F.explode(F.sequence(low, high)).alias("_at"))
            .select("_rk", "_b", "_rn", F.explode(hashed("_padded")).alias("_key")))
    whole = F.substring("_ln", start + 1, size)
    source = (L.select("_lk", "_b", "_ln", "_n", F.inline("_segs")).withColumn("_at", start)
              .select("_lk", "_b", "_ln", "_n", "_i", "_from", "_len", F.posexplode(hashed("_ln")).alias("_text", "_key")))
    found = (source.hint("merge").join(main, ["_key", "_b"]).withColumn("_m", F.length("_rn")).withColumn("_k", _max_edits(n, t)))
    window = F.substring(F.col("_rn"), low + 1, high - low + size)
    # the first text lacks the first letter
    return found.filter((F.col("_text") == 0) | (F.instr(window, whole) == 0))


def candidates(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lname: str, rname: str,
               lblock: str, rblock: str, threshold: float = NAME_THRESHOLD) -> DataFrame:
    """Pairs that share a text of a chosen segment, a row for each of them."""
    every = _candidates(left, right, lkey, rkey, lname, rname, lblock, rblock, float(threshold))
    near, rare, far = (c.select("_lk", "_rk", "_b", "_ln", "_rn") for c in every)
    return near.unionByName(rare).unionByName(far)


def _candidates(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lname: str, rname: str,
                lblock: str, rblock: str, t: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates by long segments, by rare ones and by long ones of large blocks.  In the first two ``_seg`` is the
    text of a chosen segment (``_i``), ``_chosen`` are the source name's."""
    n = F.col("_n")
    L = (left.select(F.col(lkey).alias("_lk"), F.col(lblock).cast("string").alias("_b"), F.col(lname).alias("_ln"))
         .filter(~_blank(F.col("_b")) & F.col("_ln").isNotNull() & (F.length("_ln") > 0)).distinct()
         .withColumn("_n", F.length("_ln")).withColumn("_k", _max_edits(n, t)))
    R = (right.select(F.col(rkey).alias("_rk"), F.col(rblock).cast("string").alias("_b"), F.col(rname).alias("_rn"))
         .filter(~_blank(F.col("_b")) & F.col("_rn").isNotNull()).distinct()
         .withColumn("_m", F.length("_rn")))
    R = _saved(R, "match-main")
    half = F.floor(F.col("_m") / 2).cast("int")
    halves = F.array(F.struct(F.lit(0).alias("i"), F.substring("_rn", F.lit(1), half).alias("x")),
                     F.struct(F.lit(1).alias("i"), F.substring("_rn", half + 1, F.col("_m")).alias("x")))
    common = (R.select("_b", "_m", "_rn").distinct().select("_b", "_m", F.explode(halves).alias("_h"))
              .groupBy("_b", "_m", "_h").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > COMMON)
              .select("_b", F.lit(True).alias("_common")).distinct())
    L = _saved(L.join(common, "_b", "left").join(_cuts(R, t), ["_b", "_n"], "left"), "match-source")
    near = F.col("_k").between(1, NEAR_EDITS) & ((F.col("_k") == 1) | F.col("_common").isNull())
    far = F.col("_segs").isNotNull()
    return (_near_candidates(L.filter(near), R, t), _rare_candidates(L.filter(~near & ~far), R, t),
            _far_candidates(L.filter(far), R, t))


def similar_pairs(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lname: str, rname: str,
                  lblock: str, rblock: str, threshold: float = NAME_THRESHOLD) -> DataFrame:
    """Pairs (``lkey``, ``rkey``) in the same non-blank block whose name score
    ``1 - lev(lname, rname) / len(lname)`` is at least ``threshold``.

    Exact: returns the same pairs as scoring every pair of each block.  Runs
    jobs when called (names, substrings and their counts).
    Output columns: ``_lk, _rk, _ln, _rn, _b, lev, name_score``.
    """
    n, i, seg = F.col("_n"), F.col("_i"), F.col("_seg")

    def common(j):                      # does segment j of the source name stand in the main name at one of its places
        low, high = _places(j)
        window = F.substring(F.col("_rn"), low + 1, high - low + _size(j))
        return (low <= high) & (F.instr(window, F.substring(F.col("_ln"), _start(j) + 1, _size(j))) > 0)

    def scored(pairs):                  # bounded distance: stops once it exceeds k (-1); k bounds every passing pair
        return (pairs.withColumn("lev", F.expr("levenshtein(_ln, _rn, _k)")).filter(F.col("lev") >= 0)
                .withColumn("name_score", F.lit(1.0) - F.try_divide(F.col("lev").cast("double"), n.cast("double")))
                .filter(F.col("name_score") >= F.lit(float(threshold))))

    near, rare, far = _candidates(left, right, lkey, rkey, lname, rname, lblock, rblock, float(threshold))
    # a segment that stands unchanged counts by the first of its texts only
    lead = F.substring("_ln", _start(i) + 2, _size(i) - 1)
    near = scored(near.filter((seg == lead) | ~common(i)))
    out = ["_lk", "_rk", "_ln", "_rn", "_b", "lev", "name_score"]
    first = F.get(F.filter("_chosen", common), F.lit(0))
    # a pair of the long segments can meet at a few of their texts; the others are emitted at one segment
    return (near.select(*out).unionByName(scored(far).select(*out)).distinct()
            .unionByName(scored(rare).filter(first == i).select(*out)))


def _addresses(profile: DataFrame, key: str, prefix: str) -> DataFrame:
    """All addresses of an entity as one array per (key, tax id)."""
    return profile.groupBy(F.col(key).alias(f"_{prefix}k"), F.col("tax_id").cast("string").alias("_b")).agg(
        F.collect_set(F.struct("postal_code", "address")).alias(f"_{prefix}a"))


def match_scores(src: DataFrame, main: DataFrame, key: str = "business_entity_id",
                 threshold: float = NAME_THRESHOLD) -> DataFrame:
    """Scored candidate pairs of two profiles (``key, name, tax_id, address,
    postal_code``), blocked on the tax id.

    ``name_score`` as above; ``tax_score`` 1.0 (same non-blank tax id, which
    blocking guarantees); ``address_score`` 1.0 when the two have an address
    (with its postcode) in common, else 0.0.  Pairs below ``threshold`` on the
    name are not emitted.
    """
    def kept(profile, name):             # written once, for names and addresses alike; blank tax ids never match
        return _saved(profile.select(key, "name", "tax_id", "address", "postal_code")
                      .filter(~_blank(F.col("tax_id"))), name)
    same_frame = src is main
    src = kept(src, "match-left")
    main = src if same_frame else kept(main, "match-right")
    pairs = similar_pairs(src, main, key, key, "name", "name", "tax_id", "tax_id", threshold)
    j = pairs.join(_addresses(src, key, "l"), ["_lk", "_b"]).join(_addresses(main, key, "r"), ["_rk", "_b"])
    same = F.coalesce(F.exists("_la", lambda a: F.exists("_ra", lambda b: (a["postal_code"] == b["postal_code"])
                                                         & (a["address"] == b["address"]))), F.lit(False))
    return j.select(F.col("_lk").alias(f"src_{key}"), F.col("_rk").alias(f"main_{key}"),
                    F.col("_b").alias("tax_id"), F.col("_ln").alias("src_name"), F.col("_rn").alias("main_name"),
                    "name_score", F.lit(1.0).alias("tax_score"),
                    F.when(same, 1.0).otherwise(0.0).alias("address_score"))


def flag_duplicates(scores: DataFrame, threshold: float = NAME_THRESHOLD) -> DataFrame:
    """Z3: duplicate when name score ≥ threshold and tax score = 1.0."""
    return scores.withColumn("is_duplicate",
                             (F.col("name_score") >= F.lit(threshold)) & (F.col("tax_score") == 1.0))


def drop_known(src: DataFrame, main: DataFrame, key: str, main_key: str | None = None) -> DataFrame:
    """Source rows whose key is not in main (left anti join)."""
    mk = main.select(F.col(main_key or key).alias(key)).distinct()
    return src.join(mk, key, "left_anti")


def deduplicate(src: DataFrame, main: DataFrame, key: str = "business_entity_id",
                threshold: float = NAME_THRESHOLD) -> DataFrame:
    """Route each source profile exactly once.

    * key already in main → ``update_known`` (target = own key);
    * else the best duplicate candidate (highest name score, then address
      score, then main key) → ``update_matched`` (target = that main key);
    * else → ``insert``.
    """
    mk = main.select(F.col(key).alias("_mk")).distinct()
    known = src.join(mk, src[key] == mk["_mk"], "left_semi").select(
        key, F.lit(ROUTE_UPDATE_KNOWN).alias("route"), F.col(key).alias("target_key"),
        F.lit(None).cast("double").alias("name_score"))
    unknown = drop_known(src, main, key)
    flagged = flag_duplicates(match_scores(unknown, main, key, threshold), threshold) \
        .filter("is_duplicate")
    best = latest(flagged.select(F.col(f"src_{key}").alias(key), "name_score", "address_score",
                                 F.col(f"main_{key}").alias("target_key")),
                  [key], ["name_score", "address_score"], tiebreak=["target_key"])
    routed = unknown.select(key).join(best, key, "left").select(
        key, F.when(F.col("target_key").isNotNull(), F.lit(ROUTE_UPDATE_MATCHED))
        .otherwise(F.lit(ROUTE_INSERT)).alias("route"), "target_key", "name_score")
    return known.unionByName(routed)
