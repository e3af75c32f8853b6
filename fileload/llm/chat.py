"""Chat formatting: typed content parts flattened to one training text, natively.

A visitor walks the parts of a message in order.  Text is escaped, so that no control
string of the template can occur inside it; images, audio and documents leave a
placeholder and an attachment that holds their reference and the number of tokens the
placeholder expands to.  Turns are then joined, and the assistant's contents marked
as spans for the loss.  Everything is a DataFrame expression.

Cases: a null role or text is empty; a part of unknown type counts as text; turns are
ordered by turn (null first), then role, then text, so repeated rows stay, next to
each other; messages with a null conversation id form one conversation; sizes that
are null count as one tile, second or page; an empty table gives no conversations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fileload.llm.text import col

BEGIN, END = "<s>", "</s>"
#: Strings with a meaning in the template or in ones of its family.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<image>", "<audio>", "<document>")
ESCAPE = "\u241b"
MEDIA = {"image": "i", "audio": "a", "document": "d"}

#: Tokens of an attachment: per tile of an image, second of audio, page of a document.
TILE, TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 336, 144, 25, 512

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

# An opening bracket that the rest of a control string follows.
_OPENING = "([<\\[])(?=" + "|".join(x[1:].replace("[", "\\[").replace("]", "\\]").replace("/", "\\/") for x in CONTROL) + ")"


def escape(text: Column) -> Column:
    """``text`` without control strings: an escape follows their opening bracket."""
    return F.regexp_replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e")), _OPENING, "$1" + ESCAPE + "c")


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit(ESCAPE + "c"), F.lit("")), F.lit(ESCAPE + "n"), F.lit("\n"))
    return F.replace(plain, F.lit(ESCAPE + "e"), F.lit(ESCAPE))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    nothing = {n: F.lit(None) for n in ("ref", "width", "height", "seconds", "pages")}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *(v.alias(k) for k, v in nothing.items()))).cast(f"array<{PART}>")


def expanded_tokens(part: Column) -> Column:
    one = F.lit(1)
    tiles = F.ceil(F.coalesce(part["width"], one) / TILE) * F.ceil(F.coalesce(part["height"], one) / TILE)
    return (
        F.when(part["type"] == "image", tiles * TILE_TOKENS)
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * SECOND_TOKENS))
        .otherwise(F.coalesce(part["pages"], one) * PAGE_TOKENS)
        .cast("long")
    )


def visit(parts: Column) -> tuple[Column, Column]:
    """The rendered content of a message, and its attachments in order."""

    def mark(part: Column) -> Column:
        # Media are marked behind the escape, so that texts around them are escaped
        # as one: a control string may be spread over parts.
        own = F.replace(F.coalesce(part["text"], F.lit("")), F.lit(ESCAPE), F.lit(ESCAPE + "e"))
        return reduce(lambda e, m: F.when(part["type"] == m[0], F.lit(ESCAPE + m[1])).otherwise(e), MEDIA.items(), own)

    marked = F.array_join(F.transform(parts, mark), "")
    escaped = F.regexp_replace(marked, _OPENING, "$1" + ESCAPE + "c")
    rendered = reduce(lambda e, m: F.replace(e, F.lit(ESCAPE + m[1]), F.lit(f"<{m[0]}>")), MEDIA.items(), escaped)
    attachments = F.transform(
        F.filter(parts, lambda p: p["type"].isin(*MEDIA)),
        lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("n_tokens")),
    )
    return F.coalesce(rendered, F.lit("")), F.coalesce(attachments, F.array().cast("array<struct<type:string,ref:string,n_tokens:bigint>>"))


def format_chats(messages: DataFrame, parts: Column, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role") -> DataFrame:
    """One row for each conversation: ``conv_id``, ``n_turns``, ``formatted``,
    ``loss_spans`` (start and end in characters of what the assistant says),
    ``attachments`` in the order of their placeholders, and ``media_tokens``.

    Messages are rendered before the shuffle and only laid side by side after it.
    """
    content, attachments = visit(parts)
    role = F.replace(escape(F.coalesce(col(role_col).cast("string"), F.lit(""))), F.lit("\n"), F.lit(ESCAPE + "n"))
    rows = messages.select(
        col(conv_col).alias("conv_id"),
        col(turn_col).alias("turn"),
        role.alias("role"),
        content.alias("content"),
        attachments.alias("attachments"),
    )
    head = F.concat(F.lit(BEGIN), "role", F.lit("\n"))
    rows = rows.withColumn("size", F.length(head) + F.length("content") + len(END))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    rows = rows.withColumns({"end": F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)), "place": F.row_number().over(in_order)})
    turn = F.struct(
        "place",
        F.concat(head, "content", F.lit(END)).alias("shown"),
        F.when(
            F.col("role") == "assistant",
            F.struct((F.col("end") - len(END) - F.length("content")).alias("start"), (F.col("end") - len(END)).alias("end")),
        ).alias("span"),
        "attachments",
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    found = F.flatten(F.transform("turns", lambda t: t["attachments"]))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        found.alias("attachments"),
        F.aggregate(found, F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"]).alias("media_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds; media placeholders
    are left in the text."""
    shown = F.split(formatted, END, -1)

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(BEGIN) + 1))
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(body, F.length(role) + 2)).alias("text"))

    return F.transform(F.slice(shown, F.lit(1), F.size(shown) - 1), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, with nothing between the spans."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), ""
    )
