"""Chat formatting with Spark expressions only, and reading the format back.

Turns are collected per conversation as structs and sorted by (turn, role, text);
neighbours of one role are merged into messages by array functions; a message is written as
``<|role|>`` + newline + texts joined by ``<|+|>`` + ``</s>`` and a conversation as
``<s>`` + messages. Control strings inside texts and roles are escaped reversibly, so
none of them can be taken for a mark. ``loss_spans`` holds [start, end) code-point
offsets of every text whose role is trained on.

Cases: null texts and roles are empty; a null turn sorts first; rows with a null
conversation id form one conversation; repeated rows are repeated turns; columns
besides the four named ones are ignored; an empty table gives an empty result.
A conversation becomes one string, so it must fit one row; arrays are cut in chunks where
something runs along them, so that the work is near linear in the number of turns.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items of an array in which something runs along item by item.
CHUNK = 256
BEGIN, END, OPEN, CLOSE, NEXT = "<s>", "</s>", "<|", "|>\n", "<|+|>"
#: Control strings and what stands for them inside texts, after ``&`` became ``&amp;``.
ESCAPES = (("<s>", "&bos;"), ("</s>", "&eos;"), ("<|", "&open;"), ("|>", "&close;"),
           ("[INST]", "&inst;"), ("[/INST]", "&endinst;"))


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for mark, name in ESCAPES:
        c = F.replace(c, F.lit(mark), F.lit(name))
    return c


def unescape(c: Column) -> Column:
    for mark, name in ESCAPES:
        c = F.replace(c, F.lit(name), F.lit(mark))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _chunks(items: Column, size: int) -> Column:
    """An array as an array of its consecutive parts of ``size`` items."""
    count = F.ceil(F.size(items) / size).cast("int")
    whole = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda c: F.slice(items, c * size + 1, F.lit(size)))
    return F.slice(whole, F.lit(1), count)


def _merged(turns: Column) -> Column:
    """Messages: neighbours of one role in one struct of role and texts."""
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    opens = F.filter(places, lambda i: ~F.get(turns, i)["role"].eqNullSafe(F.get(turns, i - 1)["role"]))

    def message(starts: Column) -> Column:
        return F.transform(starts, lambda s, k: F.struct(
            F.get(turns, s)["role"].alias("role"),
            F.transform(F.slice(turns, s + 1, F.coalesce(F.get(starts, k + 1), F.size(turns)) - s), lambda t: t["text"])
            .alias("texts")))

    return _bound(opens, message)


def _pieces(messages: Column, loss_roles: list[str]) -> Column:
    """One struct per turn: the marks before its text, the escaped text, whether it is trained on."""

    def of_message(m: Column, i: Column) -> Column:
        head = F.concat(F.when(i > 0, F.lit(END)).otherwise(F.lit(BEGIN)), F.lit(OPEN), escape(m["role"]), F.lit(CLOSE))
        return F.transform(m["texts"], lambda t, k: F.struct(
            F.when(k > 0, F.lit(NEXT)).otherwise(head).alias("lead"), escape(t).alias("body"),
            m["role"].isin(loss_roles).alias("loss")))

    return F.flatten(F.transform(messages, of_message))


def _spans(pieces: Column) -> Column:
    def step(s: Column, p: Column) -> Column:
        start = s["at"] + F.char_length(p["lead"])
        end = start + F.char_length(p["body"])
        spans = F.when(p["loss"], F.concat(s["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))))
        return F.struct(end.alias("at"), spans.otherwise(s["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")

    def of_chunks(chunks: Column) -> Column:
        ends = F.aggregate(chunks, F.array().cast("array<int>"), lambda done, chunk: F.concat(done, F.array(F.aggregate(
            chunk, F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)),
            lambda at, p: at + F.char_length(p["lead"]) + F.char_length(p["body"])))))
        return _bound(ends, lambda e: F.flatten(F.transform(chunks, lambda chunk, c: F.aggregate(
            chunk, F.struct(F.coalesce(F.get(e, c - 1), F.lit(0)).alias("at"), none.alias("spans")), step,
            lambda s: s["spans"]))))

    return _bound(_chunks(pieces, CHUNK), of_chunks)


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv, formatted, loss_spans): one row per conversation."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                   F.coalesce(F.col(text), F.lit("")).alias("text"))
    return (turns.groupBy(conv).agg(F.array_sort(F.collect_list(one)).alias("turns"))
            .select(conv, _merged(F.col("turns")).alias("messages"))
            .select(conv, _pieces(F.col("messages"), list(loss_roles)).alias("pieces"))
            .select(conv, F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["body"])), ""),
                                   F.lit(END)).alias("formatted"), _spans(F.col("pieces")).alias("loss_spans")))


def parse_chats(chats: DataFrame, formatted: str = "formatted", turns_col: str = "turns") -> DataFrame:
    """Adds the turns as (role, text) structs, read from the formatted string alone."""
    whole = F.col(formatted)
    body = F.substring(whole, F.lit(len(BEGIN) + 1), F.char_length(whole) - len(BEGIN) - len(END))
    messages = F.split(body, re.escape(END), -1)

    def of_message(m: Column) -> Column:
        head = F.substring_index(m, CLOSE, 1)
        rest = F.substring(m, F.char_length(head) + len(CLOSE) + 1, F.char_length(m))
        name = unescape(F.substring(head, F.lit(len(OPEN) + 1), F.char_length(head)))
        return F.transform(F.split(rest, re.escape(NEXT), -1),
                           lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))

    return chats.withColumn(turns_col, F.flatten(F.transform(messages, of_message)))


def loss_text(formatted: Column, spans: Column) -> Column:
    """Everything under the loss mask, unescaped and joined without a separator."""
    def of_chunk(chunk: Column) -> Column:
        # offsets are counted from a chunk's own part of the string
        begin = F.get(chunk, F.lit(0))["start"]
        part = F.substring(formatted, begin + 1, F.element_at(chunk, F.lit(-1))["end"] - begin)
        return _bound(part, lambda text: F.array_join(F.transform(chunk, lambda s: unescape(
            F.substring(text, s["start"] - begin + 1, s["end"] - s["start"]))), ""))

    return F.array_join(F.transform(_chunks(spans, CHUNK), of_chunk), "")
