"""Chat formatting of typed content parts.

A message is a list of parts: text, image, audio or document. A visitor turns each part into text: a
text is escaped, any other part becomes a placeholder numbered in order, with a row in the attachments
(type, reference, tokens it expands to). Turns are marked by control strings; in texts and roles the
characters that control strings need are escaped, so the format can be read back. All built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>"
#: Token rates of attachments: an image by tiles of pixels, audio by second, a document by page.
TILE, TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 28, 1, 25, 640
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    """No ``<`` and no ``[`` is left, so no control string can be; ``&`` starts an escape."""
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&a;")), F.lit("<"), F.lit("&l;")), F.lit("["), F.lit("&b;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&b;"), F.lit("[")), F.lit("&l;"), F.lit("<")), F.lit("&a;"), F.lit("&"))


def escape_name(name: Column) -> Column:
    """A role or part type between control strings: no ``|`` is left either, so nothing in it closes the mark."""
    return F.replace(escape(name), F.lit("|"), F.lit("&v;"))


def unescape_name(name: Column) -> Column:
    return unescape(F.replace(name, F.lit("&v;"), F.lit("|")))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part; null counts as empty."""
    none = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), none("string").alias("ref"),
        none("int").alias("width"), none("int").alias("height"), none("double").alias("seconds"), none("int").alias("pages"),
    ))


def expanded_tokens(p: Column) -> Column:
    """Tokens a part stands for beside its text; unknown sizes and types count as 0."""
    tiles = F.ceil(p["width"] / TILE) * F.ceil(p["height"] / TILE) * TILE_TOKENS
    known = (
        F.when(p["type"] == "image", tiles)
        .when(p["type"] == "audio", F.ceil(p["seconds"] * SECOND_TOKENS))
        .when(p["type"] == "document", p["pages"].cast("long") * PAGE_TOKENS)
    )
    return F.coalesce(known, F.lit(0)).cast("long")


def _is_text(p: Column) -> Column:
    return F.coalesce(p["type"], F.lit("text")) == "text"


def visit(parts: Column) -> Column:
    """(body, attachments) of a message; attachments are numbered from 0 in their message.

    Each part becomes text; a null list has none. A part without type is text.
    """
    zero = F.struct(F.lit("").alias("body"), F.array().cast("array<struct<number:int,type:string,ref:string,tokens:bigint>>").alias("attachments"))

    def step(acc: Column, p: Column) -> Column:
        number = F.size(acc["attachments"])
        entry = F.struct(number.alias("number"), p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens"))
        placeholder = F.concat(F.lit("<|"), escape_name(p["type"]), F.lit(":"), number.cast("string"), F.lit("|>"))
        return F.struct(
            F.concat(acc["body"], F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(placeholder)).alias("body"),
            F.when(_is_text(p), acc["attachments"]).otherwise(F.concat(acc["attachments"], F.array(entry))).alias("attachments"),
        )

    return F.aggregate(F.coalesce(parts, F.array().cast(f"array<{PART}>")), zero, step)


def format_messages(messages: DataFrame) -> DataFrame:
    """One row per conversation from ``messages`` (conv_id, turn, role, parts).

    Turns are ordered by turn, then role, then content; repeated rows stay. A null role is empty, a null
    conv_id is a conversation of its own. Columns: conv_id, n_turns, formatted, loss_spans (code points
    of assistant bodies, end exclusive), attachments (with the number of their message), expanded_tokens. Other columns are ignored.
    """
    seen = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visit(F.col("parts")).alias("v"))
    seen = seen.select("conv_id", F.struct("turn", "role", F.col("v.body").alias("body"), F.col("v.attachments").alias("attachments")).alias("m"))
    turns = seen.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("turns"))
    head = lambda t: F.concat(F.lit("<|"), escape_name(t["role"]), F.lit("|>"))
    sized = turns.withColumn("pieces", F.transform("turns", lambda t: F.struct(
        F.concat(head(t), t["body"], F.lit(END)).alias("text"), F.length(head(t)).alias("head"),
        F.length(t["body"]).alias("body"), (t["role"] == "assistant").alias("learn"),
    )))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def span(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["head"]
        both = F.struct(start.alias("start"), (start + p["body"]).alias("end"))
        return F.struct(
            (start + p["body"] + len(END)).alias("at"),
            F.when(p["learn"], F.concat(acc["spans"], F.array(both))).otherwise(acc["spans"]).alias("spans"),
        )

    files = F.flatten(F.transform("turns", lambda t, i: F.transform(t["attachments"], lambda a: a.withField("message", i))))
    return sized.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.aggregate("pieces", zero, span, lambda acc: acc["spans"]).alias("loss_spans"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation of text parts."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape_name(F.regexp_extract(p, r"^<\|([^<]*?)\|>", 1)).alias("role"),
        unescape(F.regexp_replace(p, r"^<\|[^<]*?\|>", "")).alias("text"),
    ))


def masked_text(formatted: Column, spans: Column) -> Column:
    return unescape(F.array_join(F.transform(spans, lambda s: F.substr(formatted, s["start"] + 1, s["end"] - s["start"])), ""))
