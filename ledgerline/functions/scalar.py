"""Scalar Column helpers: predicates, text, dates and numeric conversions.

Each helper returns a native Column expression.  Outside data is parsed with
the ``try_`` family so that bad text becomes NULL under ANSI mode instead of
failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text forms that mean "no structure" in a JSON-bearing column.
EMPTY_STRUCTURE_TOKENS = ("", "[]", "{}", "null")
# Text forms that make an id unusable.
INVALID_ID_TOKENS = ("", "null", "none")
# Text forms that make a cell meaningless for row filters.
MEANINGLESS_TOKENS = ("", "null")


# --- predicates (F2, F4, F5, F6, F3) ---------------------------------------

def is_empty(c) -> Column:
    """NULL, ``''``, ``[]``, ``{}`` or ``null`` (null-safe, never NULL)."""
    col = _c(c).cast("string")
    return col.isNull() | col.isin(*EMPTY_STRUCTURE_TOKENS)


def valid_name(c, case_insensitive: bool = False) -> Column:
    """not NULL, not blank after trim, and not the word ``none``.

    People names compare ``none`` case-sensitively, agent names do not; the
    flag picks the rule.
    """
    col = _c(c)
    t = F.trim(col)
    none_test = (F.lower(t) != "none") if case_insensitive else (t != "none")
    return F.coalesce(col.isNotNull() & (t != "") & none_test, F.lit(False))


def valid_id(c) -> Column:
    """not NULL and trimmed/lower-cased text not in ``'' null none``."""
    col = _c(c).cast("string")
    return F.coalesce(col.isNotNull() & ~F.lower(F.trim(col)).isin(*INVALID_ID_TOKENS),
                      F.lit(False))


def meaningful(c) -> Column:
    """Cell carries data: not NULL, not ``''``, not ``null``."""
    col = _c(c).cast("string")
    return F.coalesce(col.isNotNull() & ~col.isin(*MEANINGLESS_TOKENS), F.lit(False))


def any_meaningful(cs: Sequence) -> Column:
    """any of the columns carries data (not NULL, not ``''``, not ``null``).

    Written as one ``exists`` over an array rather than an OR tree: a wide OR
    over aliased columns makes the optimizer's constraint propagation grow
    combinatorially (it ran out of memory on a 23-column struct).
    """
    vals = F.array(*[_c(c).cast("string") for c in cs])
    return F.exists(vals, lambda x: x.isNotNull() & ~x.isin(*MEANINGLESS_TOKENS))


def any_not_null(cs: Sequence) -> Column:
    """at least one column is not NULL (works across mixed types)."""
    return F.exists(F.array(*[_c(c).isNotNull() for c in cs]), lambda b: b)


def yes_no(c) -> Column:
    """``yes`` → true, ``no`` → false (any case, trimmed), else NULL."""
    t = F.lower(F.trim(_c(c)))
    return F.when(t == "yes", F.lit(True)).when(t == "no", F.lit(False))


def blank_to_null(c, tokens: Sequence[str] = ("nan",)) -> Column:
    """F1 for one column: trimmed ``''`` or any token (any case) → NULL."""
    col = _c(c)
    t = F.lower(F.trim(col))
    return F.when(~t.isin("", *[x.lower() for x in tokens]) | col.isNull(), col)


# --- text (X1-X8) ------------------------------------------------------------

def rating_triple(kind: str, value, date) -> Column:
    """``kind;value;date`` text; NULL when any part is NULL (``concat``)."""
    return F.concat(F.lit(kind), F.lit(";"), _c(value), F.lit(";"), _c(date))


def merge_lists(a, b, sep: str = ";") -> Column:
    """Split two ``sep`` lists, union, de-duplicate, join back.

    NULL inputs count as empty lists; an empty result is NULL.
    """
    la = F.coalesce(F.split(_c(a), sep), F.array().cast("array<string>"))
    lb = F.coalesce(F.split(_c(b), sep), F.array().cast("array<string>"))
    u = F.array_distinct(F.array_union(la, lb))
    return F.when(F.size(u) > 0, F.array_join(u, sep))


def join_array(c, sep: str = ";") -> Column:
    """Array of strings → ``sep`` text, NULL when empty or NULL."""
    col = _c(c)
    return F.when(F.size(col) > 0, F.concat_ws(sep, col))


def first_char_code(c) -> Column:
    """Code of the first character (whitespace probe)."""
    return F.ascii(F.substring(_c(c), 1, 1))


# --- dates and numbers (X12-X14, X16) -----------------------------------------

def parse_date(c, fmt: str = "yyyyMMdd") -> Column:
    """Text → date by pattern, NULL when unparseable (no ANSI failure)."""
    return F.try_to_date(_c(c).cast("string"), fmt)


def julian_to_text(c) -> Column:
    """``CYYDDD`` integer → ``yyyyMMdd`` text; 0 or NULL → NULL."""
    col = _c(c)
    d = F.try_to_date((col.cast("bigint") + F.lit(1900000)).cast("string"), "yyyyDDD")
    return F.when(col.isNotNull() & (col != 0), F.date_format(d, "yyyyMMdd"))


def scaled_decimal(c, scale: int = 10000, precision: int = 38, digits: int = 5) -> Column:
    """Integer stored ×``scale`` → decimal(precision, digits)."""
    return (_c(c).cast(f"decimal({precision},0)") / F.lit(scale)).cast(f"decimal({precision},{digits})")


# Default lower bound when neither update nor load time is set.
FAR_PAST = "1900-01-01 00:00:00"


def change_time(upd, ld) -> Column:
    """X16 building block: ``coalesce(update, load, far past)``."""
    return F.coalesce(_c(upd), _c(ld), F.lit(FAR_PAST).cast("timestamp"))


def latest_change(pairs: Sequence[tuple]) -> Column:
    """Greatest change time over several (update, load) pairs."""
    return F.greatest(*[change_time(u, l) for u, l in pairs])


def count_true(cs: Sequence) -> Column:
    """``IF(a,1,0)+IF(b,1,0)+…``."""
    return reduce(lambda a, b: a + b, [F.when(_c(c), 1).otherwise(0) for c in cs])
