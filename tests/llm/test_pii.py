import re

import pytest

from ledgerline.llm import pii

BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(re.sub("[^0-9]", "", s)) <= 19 and luhn(s)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
}


def luhn(s):
    d = [int(c) for c in re.sub("[^0-9]", "", s)][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def base(text):
    found = [(m.start(), k, name, m.end()) for k, (name, (pattern, ok)) in enumerate(BASE.items())
             for m in re.finditer(pattern, text) if ok(m.group())]
    return [(name, a, b) for a, _, name, b in sorted(found)]


CASES = [
    "mail a.b@c.d.e and @x.y z@ q@r x@y..z a@b.c@d.e --@-.-", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.0004 1.2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 1 2 3 4", "+1 (017) 555-7713 +12 +1---- +123456789012345678",
    "4111111111111111.1.1.1 +4111 1111 1111 1111", "a@b.c" * 20, "é漢a@b.cö 1.1.1.1ñ", "@" * 50, "+" * 50,
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans(text):
    got = [s[:3] for s in pii.find(text) if s[0] in BASE]
    assert got == base(text)


def test_base_spans_of_documents(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert [s[:3] for s in pii.find(r["text"]) if s[0] in BASE] == base(r["text"])


def test_random_texts():
    import random
    rng = random.Random(9)
    for _ in range(3000):
        t = "".join(rng.choice("019.-+@() ab%4") for _ in range(rng.randint(0, 60)))
        assert [s[:3] for s in pii.find(t) if s[0] in BASE] == base(t)


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89 3704 0044 0532 0130 00") and not pii.mod97("DE89 3704 0044 0532 0130 01")


def test_context_decides_the_added_kinds():
    assert [s[0] for s in pii.find("IBAN DE89 3704 0044 0532 0130 00.")] == ["iban"]
    assert [s[0] for s in pii.find("his ssn is 123-45-6789")] == ["ssn"]
    assert pii.find("part 123-45-6789 of the list") == [] and pii.find("ssn 000-45-6789") == []
    plain, near = pii.find("1.2.3.4")[0][3], pii.find("server 1.2.3.4")[0][3]
    assert near > plain


def test_long_runs_are_linear():
    for t in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "+1" * 100_000, "a" * 300_000 + "@", "1 " * 150_000):
        pii.find(t)


def test_odd_rows(spark, odd, none):
    out = pii.detect(odd)
    assert sorted(out.columns) == sorted(odd.columns) and out.count() == odd.count()
    assert pii.detect(none).count() == 0
    one = spark.createDataFrame([(1, "write a@b.cd or +1 234 567 8901", "s")], none.schema)
    assert pii.redact(one).first()["text"] == "write [EMAIL] or [PHONE]"


def test_iban_before_other_words():
    from ledgerline.llm import pii
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO9386011117947"
    for text, want in [
            (f"{de} BIC COBADEFFXXX", [de]), (f"{de.replace(' ', '')} EUR 500", [de.replace(" ", "")]),
            (f"{gb} I think", [gb]), (f"{no} {de} {gb} X", [no, de, gb]), (f"AB12 {de} 7", [de]), (de, [de]),
            (f"{de}9", []), (f"{de}x", []), (f"x{de}", []), (de[:-1], []), (de.replace("89", "88"), [])]:
        assert [s[4] for s in pii.find(text) if s[0] == "iban"] == want, text
