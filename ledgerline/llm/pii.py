"""Personal data: patterns propose, checksums confirm, context adjusts the score.

Each kind has a pattern that proposes spans, a validator that drops false ones
(IP parts, Luhn, digit counts, IBAN mod 97, the number ranges of a US social
security number) and words that raise the score when they stand nearby.  The
kinds of ``BASE`` keep every validated span; the kinds of ``ADDED`` keep those
that reach ``threshold`` with their context.

Patterns are written so that scanning is linear in the text even on long runs
of digits or letters: a run is matched possessively from its start, and an
e-mail address is searched from its ``@``.

Defined cases: a null text is an empty text; repeated rows are scanned one by
one; a column named ``spans`` is replaced, others pass through; an empty table
gives an empty table.  Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.batches import map_batches, texts

_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_LENGTH = {code: n for n, codes in {      # of the IBAN registry
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for code in codes.split()}
_IBAN_REST = {n: re.compile(rf"(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in set(_IBAN_LENGTH.values())}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")


def digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def luhn(number: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(number)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    s = s[4:] + s[:4]
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses; every address is found from its ``@``."""
    free, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        start = at
        if m:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                free = m.end()
        at = text.find("@", max(free, at + 1))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping numbers: as long as the country says, whatever follows; other codes as far as they go."""
    head = _IBAN_HEAD.search(text)
    while head:
        n = _IBAN_LENGTH.get(head[0][:2])
        m = _IBAN_REST[n].match(text, head.end()) if n else _IBAN.match(text, head.start())
        found = m and mod97(text[head.start():m.end()])
        if found:
            yield head.start(), m.end()
        head = _IBAN_HEAD.search(text, m.end() if found else head.end())


def matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text))


def _ip_parts(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _card_number(s: str) -> bool:
    d = digits(s)
    return 12 <= len(d) <= 19 and luhn(d)


def _ssn_ranges(s: str) -> bool:
    area, group, serial = s.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


@dataclass(frozen=True)
class Kind:
    name: str
    propose: Callable[[str], Iterator[tuple[int, int]]]
    confirm: Callable[[str], bool]
    score: float
    context: re.Pattern


def _near(*words: str) -> re.Pattern:
    return re.compile(r"\b(?:" + "|".join(words) + r")\b", re.IGNORECASE)


BASE = (
    Kind("email", emails, lambda s: True, 0.9, _near("e-?mail", "mail", "contact", "write to")),
    Kind("ip", matches(_IP), _ip_parts, 0.6, _near("ip", "address", "host", "server", "login")),
    Kind("card", matches(_CARD), _card_number, 0.7, _near("card", "visa", "mastercard", "amex", "credit", "payment")),
    Kind("phone", matches(_PHONE), lambda s: 9 <= len(digits(s)) <= 15, 0.6,
         _near("phone", "tel", "call", "mobile", "fax")),
)
ADDED = (
    Kind("iban", ibans, mod97, 0.7, _near("iban", "account", "bank", "konto", "cuenta", "compte")),
    Kind("ssn", matches(_SSN), _ssn_ranges, 0.4, _near("ssn", "social security", "social")),
)
CONTEXT_GAIN = 0.3
SPANS = "array<struct<kind:string,start:long,end:long,score:double,text:string>>"


def find(text: str, threshold: float = 0.6, reach: int = 40) -> list[tuple[str, int, int, float, str]]:
    """All spans of one text by start, then kind as listed."""
    out = []
    for order, kind in enumerate(BASE + ADDED):
        for a, b in kind.propose(text):
            s = text[a:b]
            if not kind.confirm(s):
                continue
            near = kind.context.search(text[max(0, a - reach):a]) or kind.context.search(text[b:b + reach])
            score = min(1.0, kind.score + (CONTEXT_GAIN if near else 0.0))
            if order < len(BASE) or score >= threshold:
                out.append((a, order, kind.name, b, score, s))
    out.sort(key=lambda x: x[:2])
    return [(kind, a, b, score, s) for a, _, kind, b, score, s in out]


def detect(docs: DataFrame, text: str = "text", threshold: float = 0.6) -> DataFrame:
    """``docs`` with column ``spans`` (kind, start, end, score, text)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("score", pa.float64()), ("text", pa.string())]))

    def run(batch):
        names = ("kind", "start", "end", "score", "text")
        return {"spans": pa.array([[dict(zip(names, s)) for s in find(t, threshold)] for t in texts(batch, text)],
                                  type=kind)}
    return map_batches(docs, run, f"spans {SPANS}", text)


def redact(docs: DataFrame, text: str = "text", out: str = "text", threshold: float = 0.6) -> DataFrame:
    """``docs`` with each span of personal data replaced by ``[KIND]``; of overlapping spans the first counts."""
    def run(batch):
        done = []
        for t in texts(batch, text):
            parts, free = [], 0
            for kind, a, b, _, _ in find(t, threshold):
                if a >= free:
                    parts += [t[free:a], f"[{kind.upper()}]"]
                    free = b
            done.append("".join([*parts, t[free:]]))
        return {out: pa.array(done, pa.string())}
    return map_batches(docs, run, f"`{out}` string", text)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
