"""Conversations as one training string each, with the places that count for the loss; Spark expressions only.

A formatted conversation is a run of blocks, one per stretch of adjacent turns with one role::

    ### <role, URL-encoded>\\n<text>\\n<next/>\\n<text>\\n</turn>\\n

Marks stand at the start of a line. A control string inside a text gets one backslash more before it than it had, so no text
holds a bare one and taking one away gives the text back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

OPEN, NEXT, CLOSE = "### ", "<next/>", "</turn>"
_CONTROL = f"(?:{OPEN}|{NEXT}|{CLOSE})"
#: Elements summed by one aggregate; longer arrays go through sums of chunks, so that appending stays cheap.
_CHUNK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` names it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*+{_CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+{_CONTROL})", "$1")


def _sums(values: Column, first: Column) -> Column:
    """Sums before each element and, last, after all of them, starting at ``first``."""
    return F.aggregate(values, F.array(first), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))


def starts(lengths: Column) -> Column:
    """Where each piece of the given (int) length starts when the pieces follow each other."""
    last = (F.size(lengths) - 1).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), F.floor(last / _CHUNK).cast("int")),
                         lambda k: F.slice(lengths, k * _CHUNK + 1, F.lit(_CHUNK)))
    total = lambda chunk: F.aggregate(chunk, F.lit(0), lambda a, v: a + v)
    within = lambda chunk, first: let(_sums(chunk, first), lambda s: F.slice(s, F.lit(1), F.size(chunk)))
    placed = let(chunks, lambda parts: F.flatten(F.zip_with(
        parts, F.slice(_sums(F.transform(parts, total), F.lit(0)), F.lit(1), F.size(parts)), within)))
    return F.when(F.size(lengths) > 0, placed).otherwise(F.array().cast("array<int>"))


def merged(turns: Column) -> Column:
    """Adjacent turns of one role as one (role, texts), in order. ``turns``, an array of structs with role and text, must be a plain column."""
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    other = lambda i, j: F.coalesce(F.get(turns, i)["role"] != F.get(turns, j)["role"], F.lit(True))
    first = F.filter(places, lambda i: other(i, i - 1))
    last = F.filter(places, lambda i: other(i, i + 1))
    return F.zip_with(first, last, lambda a, b: F.struct(
        F.get(turns, a)["role"].alias("role"), F.transform(F.slice(turns, a + 1, b - a + 1), lambda t: t["text"]).alias("texts")))


def _pieces(blocks: Column, trained: str) -> Column:
    """Each text with the marks before and after it."""
    def block(b):
        head = F.concat(F.lit(OPEN), F.url_encode(b["role"]), F.lit("\n"))
        return F.transform(b["texts"], lambda t, i: F.struct(
            F.when(i == 0, head).otherwise(f"\n{NEXT}\n").alias("before"), escape(t).alias("body"),
            F.when(i == F.size(b["texts"]) - 1, f"\n{CLOSE}\n").otherwise("").alias("after"), (b["role"] == trained).alias("trained")))

    return F.flatten(F.transform(blocks, block))


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``loss`` (array of start, end), ``n_blocks``.

    ``loss`` holds the code points of ``formatted`` (end exclusive) that a model is trained on: each text of the role ``trained``, in its
    escaped form, without marks. An empty text has an empty span.

    Turns go by ``turn``, nulls first; turns at one place go by role, then text, so reruns agree. Null roles and texts are empty ones.
    Rows without a conversation form one conversation of their own. Repeated rows are turns like others. An empty table gives no
    row. Columns not named here are ignored, so their names cannot clash.

    A conversation is one row and one string, so it must fit one (2 GB); nothing is gathered beyond a conversation. Work grows with its length.
    """
    turns = rows.groupBy(F.col(conv).alias("_conv")).agg(F.sort_array(F.collect_list(F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")))).alias("_turns"))

    def whole(pieces):
        lengths = F.transform(pieces, lambda p: F.length(p["before"]) + F.length(p["body"]) + F.length(p["after"]))
        placed = F.zip_with(pieces, starts(lengths), lambda p, at: F.struct(
            p["trained"].alias("trained"), (at + F.length(p["before"])).alias("start"), (at + F.length(p["before"]) + F.length(p["body"])).alias("end")))
        return F.struct(
            F.array_join(F.transform(pieces, lambda p: F.concat(p["before"], p["body"], p["after"])), "").alias("formatted"),
            F.transform(F.filter(placed, lambda s: s["trained"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss"))

    out = let(merged(F.col("_turns")), lambda blocks: F.struct(
        let(_pieces(blocks, trained), whole).alias("out"), F.size(blocks).alias("n_blocks")))
    return (turns.select(F.col("_conv").alias(conv), out.alias("_out"))
            .select(conv, "_out.out.formatted", "_out.out.loss", F.col("_out.n_blocks").cast("long").alias("n_blocks")))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of each turn, read from a formatted conversation."""
    def block(b):
        head = F.substring_index(b, "\n", 1)
        texts = F.split(F.substr(b, F.length(head) + 2), f"\n{NEXT}\n", -1)
        role = F.url_decode(F.substr(head, F.lit(len(OPEN) + 1)))
        return let(role, lambda r: F.transform(texts, lambda t: F.struct(r.alias("role"), unescape(t).alias("text"))))

    blocks = F.filter(F.split(formatted, f"\n{CLOSE}\n", -1), lambda b: b != "")
    return F.flatten(F.transform(blocks, block))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
