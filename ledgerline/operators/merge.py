"""Upserts and merges as pure DataFrame functions.

Every merge here is ``(source, target) -> new target``: a null-safe left join
of the target rows in scope with the source, an anti join for the source rows
without a partner (the two share their exchanges, and AQE can split a hot key
in either, which it cannot in a full outer join), an ``outcome`` column per
row, and a projection.  Target rows out of scope pass through by union and are
never shuffled.  There is no driver-side row loop and no per-row statement; the
caller writes the new target once (to a new path, or as a Delta ``MERGE``
where that format is present).

Duplicate source keys are resolved before the join with a partial aggregate
(:func:`ledgerline.operators.dedupe.latest`), so a hot key cannot fan out the
join and the target stays one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.operators.conform import align
from ledgerline.operators.dedupe import latest

# Outcomes of a classification.
UPDATE, INSERT, UNCHANGED, UNTOUCHED, DELETE = "update", "insert", "unchanged", "untouched", "delete"
REJECT_UPDATE_UNMATCHED = "reject_update_unmatched"
REJECT_INSERT_MATCHED = "reject_insert_matched"
REJECT_FLAG = "reject_unknown_flag"
SUPERSEDED = "superseded"
# Helper column: source rows that share the key of the one that is merged.
ROWS = "_source_rows"
# Load flags.
FLAG_UPDATE, FLAG_INSERT = "U", "I"
# Audit columns of the main tables.
CREATED_BY, CREATED_DATE = "created_by", "created_date"
LAST_UPDATED_BY, LAST_UPDATED_DATE, IS_ACTIVE = "last_updated_by", "last_updated_date", "is_active"


@dataclass
class MergeResult:
    """Lazy results of one merge.  ``classified`` feeds all three others; persist
    or checkpoint it when more than one of them is consumed."""
    classified: DataFrame
    target: DataFrame
    rejects: DataFrame
    report: DataFrame
    columns: Sequence[Column] = ()
    kept: Column | None = None            # classified rows that are target rows (all of them by default)

    def observed(self, seen: Observation, drop_untouched: bool = False) -> DataFrame:
        """A4: the target, counting on its way.

        The action that writes the frame fills ``seen`` with ``source`` (source
        rows, superseded ones included) and the rows by outcome, so no other
        pass counts them.  ``drop_untouched`` leaves out the target rows in the
        merge's scope that no source row matched (U9 with the source as the list
        of what still exists).
        """
        o, own = F.col("outcome"), F.col("_s").isNotNull()
        counted = self.classified.observe(
            seen, F.sum(F.when(own, F.col("s_" + ROWS))).alias("source"),
            *[F.count_if(o == k).alias(k) for k in (UPDATE, INSERT, UNCHANGED, UNTOUCHED)],
            F.count_if(o.startswith("reject")).alias("rejected"))
        if self.kept is not None:
            counted = counted.filter(self.kept)
        if drop_untouched:
            counted = counted.filter((o != UNTOUCHED) | ~F.col("_in"))
        return counted.select(*self.columns)


def now_ms() -> Column:
    """Current time truncated to milliseconds."""
    return F.date_trunc("millisecond", F.current_timestamp())


def _prefixed(df: DataFrame, p: str, present: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(p + c) for c in df.columns], F.lit(True).alias(present))


def _null_safe(keys: Sequence[str], lp: str, rp: str) -> Column:
    cond = None
    for k in keys:
        c = F.col(lp + k).eqNullSafe(F.col(rp + k))
        cond = c if cond is None else cond & c
    return cond


def _outer(s: DataFrame, t: DataFrame, cond: Column) -> DataFrame:
    """Rows of a full outer join, as a left join of ``t`` and an anti join of ``s``."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema.fields]
    alone = s.join(t, cond, "left_anti").select("*", *empty)
    return t.join(s, cond, "left").select(*alone.columns).unionByName(alone)


def _report(j: DataFrame) -> DataFrame:
    """Source rows by outcome; those that a later row of the same key replaced are
    ``superseded``, so the outcomes add up to the source rows."""
    n = j.filter(F.col("_s").isNotNull()).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("s_" + ROWS) - 1).alias("more"))
    both = F.array(F.struct("outcome", "n"), F.struct(F.lit(SUPERSEDED).alias("outcome"), F.col("more").alias("n")))
    return n.select(F.inline(both)).groupBy("outcome").agg(F.sum("n").alias("n")).where("n > 0")


def _dedupe_source(src: DataFrame, keys: Sequence[str], on_duplicates: str,
                   order: Sequence[Column | str] | None) -> DataFrame:
    if on_duplicates == "latest":
        if order is None:
            order = [CREATED_DATE] if CREATED_DATE in src.columns else []
        if not order:
            raise ValueError("on_duplicates='latest' needs an order column")
        return latest(src, keys, order, count_as=ROWS)
    if on_duplicates == "raise":
        dup = src.groupBy(*keys).count().filter("count > 1").limit(1).count()
        if dup:
            raise ValueError("duplicate source keys")
        return src.withColumn(ROWS, F.lit(1).cast("long"))
    if on_duplicates == "keep":
        return src.withColumn(ROWS, F.lit(1).cast("long"))
    raise ValueError(f"unknown on_duplicates {on_duplicates!r}")


def upsert(source: DataFrame, target: DataFrame, keys: Sequence[str],
           mapping: Mapping[str, str] | None = None, flag: str = "load_flag",
           as_of: Column | None = None, on_duplicates: str = "latest",
           order: Sequence[Column | str] | None = None) -> MergeResult:
    """Apply staging rows to a main table by load flag.

    * ``U`` + key match → update; ``U`` + no match → reject;
    * ``I`` + no match → insert; ``I`` + match → reject;
    * any other flag (or NULL) → reject.  Flags compare upper-cased.
    * Matching is null-safe on ``keys`` (named as in the target; ``mapping``
      renames source columns first, e.g. ``stg_business_entity_id`` →
      ``business_entity_id``).  NULL keys match NULL keys and *are* updated.
    * Update: every source column except keys, flag, ``created_by`` and
      ``created_date`` overwrites the target, NULLs included;
      ``last_updated_by`` = source ``created_by``, ``last_updated_date`` =
      ``as_of``.
    * Insert: all source columns but the flag; ``is_active`` true,
      ``last_updated_by``/``last_updated_date`` filled when absent.
    * Of several source rows with one key the latest counts; the others are
      reported as ``superseded``, so the outcomes add up to the source rows.
    """
    as_of = as_of if as_of is not None else now_ms()
    src = source
    if mapping:
        src = src.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in src.columns])
    src = _dedupe_source(src, keys, on_duplicates, order)
    s = _prefixed(src, "s_", "_s")
    src = src.drop(ROWS)
    t = _prefixed(target, "t_", "_t")
    j = _outer(s, t, _null_safe(keys, "s_", "t_"))

    fl = F.upper(F.trim(F.col("s_" + flag)))
    sp, tp = F.col("_s").isNotNull(), F.col("_t").isNotNull()
    outcome = (F.when(sp & tp & (fl == FLAG_UPDATE), F.lit(UPDATE))
               .when(sp & ~tp & (fl == FLAG_INSERT), F.lit(INSERT))
               .when(sp & ~tp & (fl == FLAG_UPDATE), F.lit(REJECT_UPDATE_UNMATCHED))
               .when(sp & tp & (fl == FLAG_INSERT), F.lit(REJECT_INSERT_MATCHED))
               .when(sp, F.lit(REJECT_FLAG))
               .otherwise(F.lit(UNTOUCHED)))
    j = j.withColumn("outcome", outcome)
    o = F.col("outcome")
    scols = set(src.columns)
    protected = set(keys) | {flag, CREATED_BY, CREATED_DATE}

    def new_value(c: str) -> Column:
        tv = F.col("t_" + c)
        sv = F.col("s_" + c) if c in scols else None
        if c in keys:
            return F.when(o == INSERT, sv).otherwise(tv)
        if c == LAST_UPDATED_BY:
            upd = F.col("s_" + CREATED_BY) if CREATED_BY in scols else F.lit(None)
            ins = sv if sv is not None else upd
            return F.when(o == UPDATE, upd).when(o == INSERT, ins).otherwise(tv)
        if c == LAST_UPDATED_DATE:
            ins = sv if sv is not None else as_of
            return F.when(o == UPDATE, as_of).when(o == INSERT, ins).otherwise(tv)
        if c == IS_ACTIVE and sv is None:
            return F.when(o == INSERT, F.lit(True)).otherwise(tv)
        if sv is None:
            return F.when(o == INSERT, F.lit(None).cast(target.schema[c].dataType)).otherwise(tv)
        if c in protected:
            return F.when(o == INSERT, sv).otherwise(tv)
        return F.when(o.isin(UPDATE, INSERT), sv).otherwise(tv)

    columns = [new_value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    kept = tp | (o == INSERT)
    new_target = j.filter(kept).select(*columns)
    rejects = j.filter(o.startswith("reject")).select(
        *[F.col("s_" + c).alias(c) for c in src.columns], o.alias("reject_reason"))
    return MergeResult(j, new_target, rejects, _report(j), columns, kept)


def scd1_merge(source: DataFrame, target: DataFrame, keys: Sequence[str], hash_col: str,
               tgt_filter: Column | str | None = None, src_filter: Column | str | None = None,
               upd_col: str | None = None, ld_col: str | None = None,
               as_of: Column | None = None, ignore_older: bool = False,
               on_duplicates: str = "latest",
               order: Sequence[Column | str] | None = None,
               guard_col: str | None = None, evolve=None) -> MergeResult:
    """SCD type 1 merge on business keys with a change fingerprint.

    Source and target are aligned by their common columns (:func:`align`): an
    update changes those, columns that only the target has keep their values,
    and columns declared in ``evolve`` are added to the target.

    Source and target rows outside their filters do not take part (target
    rows outside ``tgt_filter`` are kept as they are).  Matched rows whose
    ``hash_col`` differs are replaced by the source row (``upd_col`` stamped
    with ``as_of``, load time kept); unmatched source rows are inserted
    (``ld_col`` stamped, ``upd_col`` NULL); equal hashes are unchanged.
    With ``ignore_older`` a source row whose ``guard_col`` (default
    ``upd_col``) is older than the stored one is ignored (late, out-of-order
    change), and a newer row with an equal hash moves the stored guard on, so
    that a change dated between the two is still late.  Use a source-time
    column as the guard when ``upd_col`` is stamped with the load time.

    Of several source rows with one key the latest by ``order`` counts (by
    default ``upd_col``, then ``ld_col``, as far as the source has them); rows
    that this does not tell apart are compared column by column, so a source
    without any time column loads too, with its greatest row.
    """
    as_of = as_of if as_of is not None else now_ms()
    src = source if src_filter is None else source.filter(src_filter)
    have = {c.lower(): c for c in src.columns}
    if missing := [c for c in (*keys, hash_col) if c.lower() not in have]:
        raise ValueError(f"the source lacks the columns {missing}")
    own_keys = [have[k.lower()] for k in keys]
    if on_duplicates == "latest":
        if order is None:
            times = [F.col(c) for c in (upd_col, ld_col) if c and c.lower() in have]
            order = [F.coalesce(*times)] if times else []
        src = latest(src, own_keys, order, count_as=ROWS)
    else:
        src = _dedupe_source(src, own_keys, on_duplicates, order)
    src, target, _ = align(src, target.withColumn(ROWS, F.lit(None).cast("long")), evolve)
    s = _prefixed(src, "s_", "_s")
    src, target = src.drop(ROWS), target.drop(ROWS)
    spelled = {c.lower(): c for c in target.columns}
    upd_col, ld_col = spelled.get((upd_col or "").lower()), spelled.get((ld_col or "").lower())
    if tgt_filter is None:
        inside, outside = target, None
    else:
        scope = F.coalesce(F.expr(tgt_filter) if isinstance(tgt_filter, str) else tgt_filter, F.lit(False))
        inside, outside = target.filter(scope), target.filter(~scope)
    j = _outer(s, _prefixed(inside, "t_", "_t"), _null_safe(keys, "s_", "t_")).withColumn("_in", F.lit(True))
    if outside is not None:
        rest = _prefixed(outside, "t_", "_t").withColumn("_in", F.lit(False))
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in s.schema.fields]
        j = j.unionByName(rest.select("*", *empty))
    sp, tp = F.col("_s").isNotNull(), F.col("_t").isNotNull()
    changed = ~F.col("s_" + hash_col).eqNullSafe(F.col("t_" + hash_col))
    guard = spelled.get((guard_col or upd_col or "").lower()) if ignore_older else None
    if ignore_older and guard not in src.columns:
        raise ValueError("ignore_older needs a guard column that source and target have")
    newer = F.coalesce(F.col("s_" + guard) >= F.col("t_" + guard), F.lit(True)) if guard else F.lit(True)
    outcome = (F.when(sp & tp & changed & newer, F.lit(UPDATE))
               .when(sp & tp, F.lit(UNCHANGED))
               .when(sp, F.lit(INSERT))
               .otherwise(F.lit(UNTOUCHED)))
    j = j.withColumn("outcome", outcome)
    o = F.col("outcome")
    scols = set(src.columns)

    def new_value(c: str) -> Column:
        tv = F.col("t_" + c)
        sv = F.col("s_" + c) if c in scols else F.when(o == UPDATE, tv)       # only the target has it: kept
        if c == upd_col:
            return F.when(o == UPDATE, as_of).when(o == INSERT, F.lit(None)).otherwise(tv)
        if c == ld_col:
            return F.when(o == INSERT, as_of).otherwise(tv)
        if c == guard:
            return F.when(o.isin(UPDATE, INSERT), sv).when((o == UNCHANGED) & newer, F.coalesce(sv, tv)).otherwise(tv)
        return F.when(o.isin(UPDATE, INSERT), sv).otherwise(tv)

    columns = [new_value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    new_target = j.select(*columns)
    rejects = j.filter(F.lit(False)).select(*[F.col("s_" + c).alias(c) for c in src.columns])
    return MergeResult(j, new_target, rejects, _report(j), columns)


def merge_update(source: DataFrame, target: DataFrame, on: Sequence[str], columns: Sequence[str],
                 source_filter: Column | str | None = None) -> DataFrame:
    """U8: update-only merge of chosen columns; unmatched rows change nothing.

    The source is reduced to one row per key (any duplicate would make the
    update ambiguous; the greatest row wins deterministically).
    """
    src = source if source_filter is None else source.filter(source_filter)
    src = src.groupBy(*on).agg(*[F.max(F.struct(*[F.col(c) for c in columns])).alias("_u")])
    s = src.select(*[F.col(k).alias("_k_" + k) for k in on], "_u", F.lit(True).alias("_m"))
    cond = None
    for k in on:
        c = target[k].eqNullSafe(s["_k_" + k])
        cond = c if cond is None else cond & c
    j = target.join(s, cond, "left")
    return j.select(*[
        F.when(F.col("_m").isNotNull(), F.col(f"_u.{c}")).otherwise(target[c]).alias(c)
        if c in columns else target[c] for c in target.columns])


def hard_delete(source: DataFrame, target: DataFrame, keys: Sequence[str],
                scope: Column | str | None = None, default: str | None = None) -> DataFrame:
    """Drop target rows in ``scope`` that no source row matches.

    Matching is null-safe on ``keys``; ``default`` reproduces
    ``coalesce(x, d) = coalesce(y, d)``.  Rows outside ``scope`` stay.
    Written as one left-anti join over in-scope rows plus the out-of-scope
    rows, not a driver-side delete list.
    """
    sc = F.lit(True) if scope is None else (F.expr(scope) if isinstance(scope, str) else scope)
    t = target.withColumn("_scope", F.coalesce(sc, F.lit(False)))
    src_keys = source.select(*[F.col(k).alias("_s_" + k) for k in keys]).distinct()
    cond = None
    for k in keys:
        if default is not None:
            c = (F.coalesce(t[k].cast("string"), F.lit(default))
                 == F.coalesce(src_keys["_s_" + k].cast("string"), F.lit(default)))
        else:
            c = t[k].eqNullSafe(src_keys["_s_" + k])
        cond = c if cond is None else cond & c
    kept_in_scope = t.filter("_scope").join(src_keys, cond, "left_semi")
    return t.filter(~F.col("_scope")).unionByName(kept_in_scope).drop("_scope")


def inactive_to_null(value, active_flag, active: str = "Y", replacement=None) -> Column:
    """Values from inactive rows become NULL (or ``replacement``, e.g. ``'-1'``)."""
    v = F.col(value) if isinstance(value, str) else value
    a = F.col(active_flag) if isinstance(active_flag, str) else active_flag
    rep = F.lit(replacement) if replacement is not None else F.lit(None)
    return F.when(a == active, v).otherwise(rep)
