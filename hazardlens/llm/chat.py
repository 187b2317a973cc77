"""Chat formatting with relational expressions only.

The turns of a conversation are collected as structs and sorted; runs of one role are merged into blocks by array
functions; blocks become strings. A block is ``<|begin|>role<|body|>text<|next|>text<|end|>``: texts of merged
turns stay apart, so the output can be read back turn by turn. Control strings inside roles and texts, those of this
template and of other common ones, get a backslash after their first character (one more if backslashes are there
already), which is undone exactly when reading.

A conversation becomes one string, so its turns meet in one task, as the output demands.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.common import let

BEGIN, BODY, NEXT, END = "<|begin|>", "<|body|>", "<|next|>", "<|end|>"
#: Control strings of common chat templates.
OTHER_CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
                  "<|endoftext|>", "<|startoftext|>", "<unk>", "<pad>")
CONTROLS = (BEGIN, BODY, NEXT, END, *OTHER_CONTROLS)

_RESTS = "|".join(re.sub(r"([|\[\]])", r"\\\1", c[1:]) for c in CONTROLS)
ESCAPE_PATTERN = rf"([<\[])(\\*)({_RESTS})"
_UNESCAPE_PATTERN = rf"([<\[])\\(\\*)({_RESTS})"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE_PATTERN, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE_PATTERN, "$1$2$3")


def _literal(mark: str) -> str:
    return mark.replace("|", r"\|")


def _blocks(turns: Column) -> Column:
    """Runs of turns of one role as (role, texts)."""
    starts = F.filter(F.sequence(F.lit(0), F.size(turns) - 1),
                      lambda i: (i == 0) | (F.get(turns, i).role != F.get(turns, i - 1).role))
    return let(starts, lambda s: F.transform(s, lambda at, k: F.struct(
        F.get(turns, at).role.alias("role"),
        F.transform(F.slice(turns, at + 1, F.coalesce(F.get(s, k + 1), F.size(turns)) - at),
                    lambda t: escaped(t.text)).alias("texts"))))


def _formatted(blocks: Column) -> Column:
    return F.array_join(F.transform(blocks, lambda b: F.concat(
        F.lit(BEGIN), escaped(b.role), F.lit(BODY), F.array_join(b.texts, NEXT), F.lit(END))), "")


def _loss_spans(blocks: Column, loss_role: str) -> Column:
    """Where the texts of ``loss_role`` lie in the formatted string (code points, end exclusive)."""
    pieces = F.flatten(F.transform(blocks, lambda b: F.transform(b.texts, lambda t, i: F.struct(
        F.when(i > 0, len(NEXT)).otherwise(
            F.char_length(escaped(b.role)) + len(BEGIN) + len(BODY)).alias("lead"),
        F.char_length(t).alias("length"),
        F.when(i + 1 < F.size(b.texts), 0).otherwise(len(END)).alias("tail"),
        (b.role == loss_role).alias("loss")))))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(done: Column, p: Column) -> Column:
        start = done.at + p.lead
        return F.struct((start + p.length + p.tail).alias("at"), F.when(p.loss, F.concat(done.spans, F.array(
            F.struct(start.alias("start"), (start + p.length).alias("end"))))).otherwise(done.spans).alias("spans"))

    return F.aggregate(pieces, nothing, add, lambda done: done.spans)


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``.

    Turns are in order of turn number (null first), then role, then text; repeated rows stay. Null text and null
    role count as empty; turns with a null conversation form one. Texts that are empty give empty spans. An empty
    table gives no rows; other columns are not read."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.struct(
            F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).alias("said"))
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    whole = let(let(F.col("turns"), _blocks), lambda b: F.struct(
        _formatted(b).alias("formatted"), _loss_spans(b, loss_role).alias("loss_spans")))
    return collected.select("conv_id", whole.alias("whole")).select("conv_id", "whole.*")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    blocks = F.filter(F.split(formatted, _literal(BEGIN)), lambda b: b != "")
    return F.flatten(F.transform(blocks, lambda b: let(F.split(b, _literal(BODY)), lambda halves: F.transform(
        F.split(F.regexp_replace(halves[1], _literal(END) + r"\z", ""), _literal(NEXT)),
        lambda t: F.struct(unescaped(halves[0]).alias("role"), unescaped(t).alias("text"))))))


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(
        loss_spans, lambda s: unescaped(F.substring(formatted, s.start + 1, s.end - s.start))), "")
