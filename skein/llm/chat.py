"""Chat formatting with Spark expressions only.

Turn structs are collected per conversation and sorted, adjacent turns of one
role share a block, and the blocks are concatenated:

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Control strings inside roles and texts are escaped reversibly: a backslash is
doubled, ``<|`` becomes ``<\\|`` and, in roles, a newline becomes ``<\\n``.
After the doubling a single backslash after ``<`` can only come from the
escape, so undoing the three replacements in reverse order restores the text.

A conversation is the unit of output, one string, so its rows meet in one
task; nothing wider than one conversation is ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
STEP = 256  # turns per block of the running offsets


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("<\\n"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("<\\n"), F.lit("\n")))


def _running(lengths: Column) -> Column:
    """Offset before each element. Sums of STEP elements come first, so that
    the cost is n * STEP + (n / STEP)^2 and not n^2."""
    whole = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(lengths) - 1) / STEP), F.lit(0)).cast("int")),
                        lambda b: F.aggregate(F.slice(lengths, b * STEP + 1, STEP), F.lit(0).cast("long"), lambda s, x: s + x))
    before = F.transform(whole, lambda _, b: F.aggregate(F.slice(whole, F.lit(1), b), F.lit(0).cast("long"), lambda s, x: s + x))
    return F.transform(lengths, lambda _, i: F.element_at(before, (F.floor(i / STEP) + 1).cast("int")) + F.aggregate(
        F.slice(lengths, (F.floor(i / STEP) * STEP + 1).cast("int"), (i % STEP).cast("int")), F.lit(0).cast("long"), lambda s, x: s + x))


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", learn_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``id_col``, ``formatted`` and ``loss_spans``,
    the [start, end) code-point ranges of the texts to learn (``learn_role``).

    Null texts and roles count as empty. Turns sort by number (null first),
    then role, then text, so ties and repeated rows have a fixed order and all
    stay. Rows with a null id form one conversation. An empty table gives none.
    Only the four named columns are read.
    """
    t = turns.select(F.col(f"`{id_col}`").alias("conv"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).alias("t"))
    g = t.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("ts"))

    def part(x, i):
        first = (i == 0) | (F.get("ts", i - 1)["role"] != x["role"])
        last = (i == F.size("ts") - 1) | (F.get("ts", i + 1)["role"] != x["role"])
        return F.struct(
            F.when(first, F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n"))).otherwise(F.lit(SEP)).alias("head"),
            escape(x["text"]).alias("body"),
            F.when(last, F.lit(END + "\n")).otherwise(F.lit("")).alias("tail"),
            (x["role"] == learn_role).alias("learn"))

    g = g.select("conv", F.transform("ts", part).alias("p"))
    size = F.transform("p", lambda x: (F.length(x["head"]) + F.length(x["body"]) + F.length(x["tail"])).cast("long"))
    g = (g.select("conv", "p", size.alias("sizes")).select("conv", "p", _running(F.col("sizes")).alias("at")))
    span = F.zip_with("p", "at", lambda x, at: F.when(x["learn"], F.struct(
        (at + F.length(x["head"])).alias("start"), (at + F.length(x["head"]) + F.length(x["body"])).alias("end"))))
    return g.select(
        F.col("conv").alias(id_col),
        F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], x["tail"])), "").alias("formatted"),
        F.filter(span, lambda s: s.isNotNull()).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda _, i: i > 0)

    def turns_of(block):
        cut = F.instr(block, "\n")
        role = unescape_role(F.substr(block, F.lit(1), cut - 1))
        body = F.substr(block, cut + 1, F.length(block) - cut - len(END) - 1)
        return F.transform(F.split(body, r"<\|im_sep\|>", -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(pieces, turns_of))


def learned_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
