"""Chat formatting with Spark expressions only: turns of a conversation to one marked-up text and its loss spans, and back."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around messages, and strings of other templates that must not stand in a text unescaped either."""

    start: str = "<|im_start|>"
    body: str = "<|im_sep|>"
    next: str = "<|im_next|>"
    end: str = "<|im_end|>"
    foreign: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")

    def controls(self) -> tuple[str, ...]:
        return (self.start, self.body, self.next, self.end, *self.foreign)


def escape(text: Column, template: ChatTemplate) -> Column:
    """Double each backslash, then put one after the first character of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.controls():
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate(), learn_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans: one row per conversation, from rows conv_id, turn, role, text.

    Turns are collected and sorted by (turn, role, text); adjacent turns of one role merge into one
    message whose parts keep a mark between them. loss_spans holds (start, chars), from 0 in code
    points, of each text of learn_role. Null role and text count as empty, a null turn sorts first,
    repeated rows stay repeated turns, rows with a null conv_id form one conversation, an empty table
    gives no rows. Extra columns are ignored. A conversation is one value of the result, so its turns
    meet in one task; different conversations never do, and the work grows linearly with its turns.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text")))).alias("turns"))

    def part(t: Column, i: Column) -> Column:
        opened = F.concat(F.when(i == 0, F.lit("")).otherwise(F.lit(template.end)), F.lit(template.start), escape(t["role"], template), F.lit(template.body))
        same = F.coalesce(F.get("turns", i - 1)["role"] == t["role"], F.lit(False))
        return F.struct(F.when(same, F.lit(template.next)).otherwise(opened).alias("head"), escape(t["text"], template).alias("text"), (t["role"] == learn_role).alias("learn"))

    parts = sorted_turns.select("conv_id", F.posexplode(F.transform("turns", part)).alias("pos", "p"))
    upto = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chars = F.char_length("p.text").cast("long")
    placed = parts.select("conv_id", "pos", F.concat("p.head", "p.text").alias("piece"), "p.learn", chars.alias("chars"), (F.sum(F.char_length("p.head") + chars).over(upto) - chars).alias("start"))
    merged = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "piece", "learn", "start", "chars"))).alias("m"))
    spans = F.transform(F.filter("m", lambda x: x["learn"]), lambda x: F.struct(x["start"].alias("start"), x["chars"].alias("chars")))
    return merged.select("conv_id", F.concat(F.array_join(F.transform("m", lambda x: x["piece"]), ""), F.lit(template.end)).alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """conv_id, turns (array of role, text), loss_texts (array), from the columns of format_conversations."""
    cut = lambda text, mark: F.split(text, re.escape(mark), -1)
    messages = F.filter(cut(F.col("formatted"), template.end), lambda m: m != "")

    def turns(message: Column) -> Column:
        halves = cut(F.substr(message, F.lit(len(template.start) + 1)), template.body)
        return F.transform(cut(halves[1], template.next), lambda text: F.struct(unescape(halves[0]).alias("role"), unescape(text).alias("text")))

    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["chars"].cast("int"))))
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(messages, turns)).alias("turns"), loss.alias("loss_texts"))
