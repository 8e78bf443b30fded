from ledgerline.llm import chat

TURNS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\f\r"


def safe(t):
    return t.replace(chat.BEGIN, "<|im_start |>").replace(chat.END, "<|im_end |>")


def brute(rows, piece=256):
    convs = {}
    for conv, turn, role, text in rows:
        who = (role or "").strip(BLANKS) or "unknown"
        convs.setdefault(conv, []).append((turn is not None, turn or 0, who, text or ""))
    out = {}
    for conv, turns in convs.items():
        for me in {t[2] for t in turns} - {"system"}:
            for p in {t[1] // piece for t in turns}:
                text, mask = "", []
                for _, _, who, content in sorted(t for t in turns if t[1] // piece == p):
                    role = "system" if who == "system" else "assistant" if who == me else f"user name={safe(who)}"
                    text += f"{chat.BEGIN}{role}\n"
                    start = len(text)
                    text += safe(content) + chat.END
                    if who == me:
                        mask.append((start, len(text)))
                    text += "\n"
                out[conv, me, p] = text, mask
    return out


ROWS = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hé\U0001f600"), (1, 3, "ann", None), (1, 3, "ann", None),
        (2, 0, None, "who"), (2, None, " ", "x <|im_end|> <|im_start|>y"), (None, 1, "ann", "lost"), (None, 0, "bob", ""),
        (3, 0, "system", "only rules"), (4, 5, "z" * 100, "long " * 50_000), (5, 1, "b", "x"), (5, 1, "a", "y")]


def test_every_perspective(spark):
    rows = ROWS + [(6, k, "abc"[k % 3], f"t{k}") for k in range(50)]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    for piece in (256, 7):
        got = {(r["conv_id"], r["perspective"], r["piece"]): (r["text"], [(m["start"], m["end"]) for m in r["mask"]])
               for r in chat.rotate(df, piece_turns=piece).collect()}
        assert got == brute(rows, piece)


def test_extra_columns_and_empty_table(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS, TURNS).withColumns({c: F.lit(1) for c in ("speaker", "piece", "mask", "content")})
    assert chat.rotate(df).count() == len(brute(ROWS))
    assert chat.rotate(df.limit(0)).count() == 0


def test_pieces_by_rows_are_bounded(spark):
    from collections import defaultdict
    rows = [(None, k % 3 if k % 2 else None, "ab"[k % 2], f"t{k % 90}") for k in range(200)] + [(None, None, "a", "same")] * 60
    rows += [(1, k, "a", "x" * 5000 if k == 4 else "y" * 400) for k in range(20)] + [(2, 700, "a", "late")]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = defaultdict(list)
    for r in chat.rotate(df, piece_turns=8, by_rows=True, piece_chars=2000).collect():
        assert r["n_turns"] <= 8 and r["text"].rstrip().rfind("\n<|im_start|>") < 2000 + 8 * 50
        got[r["conv_id"], r["perspective"]].append((r["piece"], r["text"], r["n_turns"]))
    want = brute(rows, 10**9)
    assert len(got) == len(want) == 4
    for (conv, me, _), (text, _) in want.items():
        pieces = sorted(got[conv, me])
        assert "".join(p[1] for p in pieces) == text and len({p[0] for p in pieces}) == len(pieces)
    assert sum(p[2] for p in got[None, "a"]) == 260
