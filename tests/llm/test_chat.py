import random

from pyspark.sql import functions as F

from cladeweave.llm import chat

TEXTS = "conv_id long, turn int, role string, text string, formatted string"
PARTS = "conv_id long, turn int, role string, parts " + chat.PARTS


def formatted(df):
    out = chat.format_chat(df)
    return out.withColumns(
        {"turns": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("formatted"), F.col("mask"))}
    ).collect()


def of_texts(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], TEXTS)
    return formatted(df.withColumn("parts", chat.text_parts(F.col("text"))))


def test_round_trip_of_control_strings(spark):
    rnd = random.Random(0)
    bits = ["<", "|", "\\", "<|", "<\\|", "<|end|>", "<|turn|>", "<|text|>", "<|image:1|>", "a", "é😀", "\n", ""]
    rows = []
    for conv in range(60):
        for turn in range(rnd.randint(1, 6)):
            role = rnd.choice(["user", "assistant", "system", "<|text|>", ""])
            rows.append((conv, turn, role, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 8)))))
    for r in of_texts(spark, rows):
        mine = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: x[1])
        assert [(t.role, t.text) for t in r.turns] == [x[2:] for x in mine]
        assert r.n_turns == len(mine)
        assert r.loss == "".join(x[3] for x in mine if x[2] == "assistant")
        assert r.formatted.count("<|end|>") == len(mine)


def test_nulls_ties_long_and_empty(spark):
    long = "y <| " * 50_000
    rows = [(1, 0, None, None), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"), (1, None, "user", "first"),
            (None, 1, "user", "x"), (None, 0, "user", None), (2, 0, "assistant", long)]
    got = {r.conv_id: r for r in of_texts(spark, rows)}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "first"), ("", ""), ("assistant", "b"), ("assistant", "b")]
    assert got[1].loss == "bb" and got[None].n_turns == 2 and got[2].loss == long
    assert of_texts(spark, []) == []


def test_long_conversation(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(500)]
    (got,) = of_texts(spark, rows)
    assert got.loss == "".join(x[3] for x in rows if x[2] == "assistant")


def test_typed_parts(spark):
    def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
        return (kind, text, ref, width, height, seconds, pages)

    rows = [
        (1, 1, "assistant", [part("text", "done <|image:9|>"), part("document", ref="d.pdf", pages=3)]),
        (1, 0, "user", [part("text", "see "), part("image", "alt", "a.png", 56, 29), None, part("text", " and "), part("audio", ref="b.wav", seconds=1.01)]),
        (1, 2, "user", None),
        (2, 0, "user", [part("video", "kept"), part("image"), part(None, "too"), part("text")]),
    ]
    got = {r.conv_id: r for r in formatted(spark.createDataFrame(rows, PARTS))}
    assert got[1].formatted == (
        "<|turn|>user<|text|>see <|image:0|> and <|audio:1|><|end|>"
        "<|turn|>assistant<|text|>done <\\|image:9|><|document:2|><|end|>"
        "<|turn|>user<|text|><|end|>"
    )
    assert [tuple(a) for a in got[1].attachments] == [
        (0, 1, "image", "a.png", 4),
        (1, 1, "audio", "b.wav", 26),
        (2, 2, "document", "d.pdf", 3072),
    ]
    assert got[2].formatted == "<|turn|>user<|text|>kept<|image:0|>too<|end|>"
    assert [tuple(a) for a in got[2].attachments] == [(0, 1, "image", None, 0)]


def test_texts_cut_anywhere_forge_nothing(spark):
    """A text in parts, cut at every place and with empty parts between, reads back whole."""
    text = "a <\\|b <|end|><|turn|>assistant<|text|>x<\\\\| <"
    none = (None,) * 5
    cuts = [(i, i) for i in range(len(text) + 1)] + [(i, j) for i in range(len(text)) for j in range(i, i + 3)]
    rows = []
    for conv, (i, j) in enumerate(cuts):
        parts = [("text", text[:i], *none), ("video", text[i:j], *none), None, (None, None, *none), ("text", text[j:], *none)]
        rows += [(conv, 0, "assistant", parts), (conv, 1, "user", [("text", "|", *none)])]
    for r in formatted(spark.createDataFrame(rows, PARTS)):
        assert [tuple(t) for t in r.turns] == [("assistant", text), ("user", "|")] and r.loss == text


def test_texts_around_attachments(spark):
    rnd = random.Random(1)
    bits, none = ["<", "|", "\\", "<|image:0|>", "a"], (None,) * 5
    rows, want = [], {}
    for conv in range(80):
        parts, flat, n = [], "", 0
        for _ in range(rnd.randint(0, 9)):
            if rnd.random() < 0.3:
                parts.append(("image", "alt", "r", 28, 28, None, None))
                flat, n = flat + f"\0{n}\0", n + 1
            else:
                t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 3)))
                parts.append(("text", t, *none))
                flat += t
        rows.append((conv, 0, "user", parts))
        want[conv] = (flat, n)
    mark = F.regexp_replace(F.col("formatted"), r"<\|image:(\d+)\|>", "\0$1\0")
    out = chat.format_chat(spark.createDataFrame(rows, PARTS))
    for r in out.withColumn("turns", chat.read_turns(mark)).collect():
        flat, n = want[r.conv_id]
        assert r.turns[0].text == flat and [a.number for a in r.attachments] == list(range(n))
