"""Chat formatting with typed content parts.

A message has parts of a type each: text, image, audio or document. The visitor turns a
run of adjacent text parts into its escaped text, so that no control string can be made
of the end of one part and the beginning of the next, and any other part into a
placeholder ``<|image:3|>`` numbered in order through the conversation, of which the
reference, the message and the number of tokens it expands to are recorded.

Every message is ``<|turn|>role<|text|>content<|end|>``. Control strings begin with
``<|``, which a text never holds after escaping: ``<``, any backslashes, ``|`` gets one
backslash more, which is taken away again on reading. The loss mask is a list of
(start, length) in characters of the formatted text, one per assistant message.

A conversation is the unit of output, one row with one string, so its messages meet
in one task; nothing larger does. Only built-in functions are used.

Nulls and odd cases: null text, role or part is empty text; parts of another type are
kept as text; messages with the same turn are ordered by role and text; rows without
conv_id form one conversation; an empty table has no conversations; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ASSISTANT = "assistant"

#: tokens: pixels a side of an image patch, audio frames a second, tokens a page
PATCH, FRAMES, PAGE = 28, 25, 1024

PARTS = (
    "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _patches(side: Column) -> Column:
    return F.ceil(F.coalesce(side, F.lit(0)) / PATCH)


#: number of tokens by type of attachment
EXPANSIONS: dict[str, Callable[[Column], Column]] = {
    "image": lambda p: _patches(p["width"]) * _patches(p["height"]),
    "audio": lambda p: F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * FRAMES),
    "document": lambda p: F.coalesce(p["pages"], F.lit(0)).cast("long") * PAGE,
}


def visit_texts(parts: Column) -> Column:
    """Text of a run of parts without attachments."""
    return escape(F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), ""))


def visit_attachment(part: Column, number: Column) -> Column:
    """Placeholder of a part; ``number`` counts the attachments of the conversation."""
    return F.concat(F.lit("<|"), part["type"], F.lit(":"), number.cast("string"), F.lit("|>"))


def visit(parts: Column, first: Column) -> Column:
    """Text of a message whose first attachment has the number ``first``."""
    places = F.filter(
        F.transform(parts, lambda p, i: F.when(p["type"].isin(*EXPANSIONS), i + 1)), lambda i: i.isNotNull()
    )
    runs = F.zip_with(
        F.concat(F.array(F.lit(0)), places),
        F.concat(places, F.array(F.size(parts) + 1)),
        lambda a, b: visit_texts(F.slice(parts, a + 1, b - a - 1)),
    )
    placeholders = F.transform(places, lambda at, i: visit_attachment(F.element_at(parts, at), first + i))
    # one run more than placeholders
    return F.array_join(F.zip_with(runs, placeholders, lambda r, p: F.concat(r, F.coalesce(p, F.lit("")))), "")


def expanded(part: Column) -> Column:
    """Tokens that an attachment stands for."""
    found = F.lit(None).cast("long")
    for kind, tokens in EXPANSIONS.items():
        found = F.when(part["type"] == kind, tokens(part).cast("long")).otherwise(found)
    return found


def _attachments(parts: str) -> Column:
    return F.filter(parts, lambda p: p["type"].isin(*EXPANSIONS))


def text_parts(text: Column) -> Column:
    """A plain text as the only part of its message."""
    none = [F.lit(None).alias(n) for n in ("ref", "width", "height", "seconds", "pages")]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *none)).cast(PARTS)


def format_chat(messages: DataFrame) -> DataFrame:
    """One row per conversation: formatted, mask, n_turns, attachments.

    ``messages`` has conv_id, turn, role and ``parts`` as in ``PARTS``.
    """
    rows = messages.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.filter("parts", lambda p: p.isNotNull()), F.array().cast(PARTS)).alias("parts"),
    )
    plain = F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], F.lit(""))), "")
    rows = rows.withColumn("_order", F.struct(F.col("turn"), F.col("role"), plain, F.col("parts")))
    own = _attachments("parts")
    by_order = Window.partitionBy("conv_id").orderBy("_order")
    before = by_order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_first", F.coalesce(F.sum(F.size(own)).over(before), F.lit(0)))
    rows = rows.withColumn("_content", visit(F.col("parts"), F.col("_first")))
    rows = rows.withColumn("_head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)))
    rows = rows.withColumn("_line", F.concat("_head", "_content", F.lit(END)))
    rows = rows.withColumn("_start", F.coalesce(F.sum(F.length("_line")).over(before), F.lit(0)))
    rows = rows.withColumn("_at", F.row_number().over(by_order))
    attached = F.transform(
        own,
        lambda p, i: F.struct(
            (F.col("_first") + i).alias("number"),
            F.col("_at").alias("message"),
            p["type"].alias("type"),
            p["ref"].alias("ref"),
            expanded(p).alias("n_tokens"),
        ),
    )
    mask = F.when(
        F.col("role") == ASSISTANT,
        F.struct(
            (F.col("_start") + F.length("_head")).cast("long").alias("start"),
            F.length("_content").cast("long").alias("length"),
        ),
    )
    line = F.struct(F.col("_at"), F.col("_line"), mask.alias("_mask"), attached.alias("_attached"))
    lines = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(line)).alias("_lines"))
    return lines.select(
        "conv_id",
        F.array_join(F.transform("_lines", lambda x: x["_line"]), "").alias("formatted"),
        F.filter(F.transform("_lines", lambda x: x["_mask"]), lambda m: m.isNotNull()).alias("mask"),
        F.size("_lines").cast("long").alias("n_turns"),
        F.flatten(F.transform("_lines", lambda x: x["_attached"])).alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """Messages of a formatted text as an array of (role, text), unescaped."""
    lines = F.filter(F.split(formatted, r"<\|end\|>"), lambda x: x != "")

    def turn(line: Column) -> Column:
        fields = F.split(F.substring(line, len(TURN) + 1, 2**31 - 1), r"<\|text\|>")
        return F.struct(unescape(fields[0]).alias("role"), unescape(fields[1]).alias("text"))

    return F.transform(lines, turn)


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            mask,
            lambda m: unescape(F.substring(formatted, m["start"].cast("int") + 1, m["length"].cast("int"))),
        ),
        "",
    )
