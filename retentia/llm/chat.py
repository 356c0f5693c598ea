"""Chat formatting by prefix-target expansion (operator 1).

Every assistant turn becomes an example of its own: all preceding turns as context
and that reply as the only trainable text. An example is the conversation's formatted
text up to the end of the reply, with the place of the reply (code points) as its loss
mask. A conversation whose last turn is not the assistant's also gives one example
without a target, so that no turn is lost.

Template: ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end for
each turn. Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so
no control string can occur there; a line end in a role becomes ``\\n``. ``read_turns``
and ``unescape`` undo this.

Defined results: null text and null role are empty; very long texts are kept whole; rows of the same conversation and
turn are ordered by role and text and all kept; a null turn comes first; rows with a null
conv_id form one conversation; an empty table gives no rows; columns beyond the four are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """A doubled backslash hides what follows it: cut there, undo the rest, join again."""
    return F.array_join(
        F.transform(F.split(text, r"\\\\"), lambda part: F.replace(
            F.replace(part, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n"))), "\\")


def format_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, example, is_target, text, loss_start, loss_chars): one row for each
    assistant turn, and one with ``is_target`` false for turns after the last reply.
    ``loss_start`` counts code points from 0; the loss mask is empty without a target."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    conversations = (turns
                     .select(F.col(conv_col).alias("conv_id"),
                             F.struct(F.col(turn_col).alias("turn"), role.alias("role"),
                                      text.alias("text")).alias("row"))
                     .groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows")))
    formatted = conversations.select(
        "conv_id",
        F.transform("rows", lambda r: F.struct(
            (r["role"] == "assistant").alias("target"),
            F.concat(F.lit(START), F.replace(escape(r["role"]), F.lit("\n"), F.lit("\\n")),
                     F.lit("\n"), escape(r["text"]), F.lit(END)).alias("text"),
            F.length(escape(r["text"])).alias("chars"))).alias("parts"))
    cuts = F.filter(F.transform("parts", lambda p, i: F.struct(
        i.alias("at"), p["target"].alias("target"), p["chars"].alias("chars"))),
        lambda c: c["target"] | (c["at"] == F.size("parts") - 1))
    texts = F.transform("parts", lambda p: p["text"])
    each = (formatted.select("conv_id", texts.alias("texts"), F.posexplode(cuts).alias("example", "cut"))
            .select("conv_id", F.col("example").cast("int"), F.col("cut.target").alias("is_target"),
                    F.array_join(F.slice("texts", F.lit(1), F.col("cut.at") + 1), "").alias("text"),
                    F.when(F.col("cut.target"), F.col("cut.chars")).otherwise(0).alias("loss_chars")))
    end = F.when(F.col("is_target"), F.length("text") - len(END)).otherwise(F.length("text"))
    return each.select("conv_id", "example", "is_target", "text",
                       (end - F.col("loss_chars")).alias("loss_start"), "loss_chars")


def loss_text(text: Column, start: Column, chars: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.substring(text, start + 1, chars))


def read_turns(text: Column) -> Column:
    """A formatted text back as ``array<struct<role, text>>``."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text")))


def read_back(examples: DataFrame) -> DataFrame:
    """For each conversation, from its examples alone: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars (of all its examples)."""
    turns = F.col("turns")
    longest = F.col("last.turns")
    one = examples.select(
        "conv_id", "example", F.length("text").alias("chars"),
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("loss"),
        # only the last example of a conversation, which holds all its turns, is parsed
        F.when(F.col("example") == F.max("example").over(_by_conversation()),
               read_turns(F.col("text"))).alias("turns"))
    grouped = one.groupBy("conv_id").agg(
        F.max(F.struct(turns.isNotNull().alias("is_last"), turns.alias("turns"))).alias("last"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("chars").alias("formatted_chars"))
    whole = F.array_join(F.transform(longest, lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return grouped.select(
        "conv_id", F.size(longest).cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.col("formatted_chars").cast("long"))


def _by_conversation():
    from pyspark.sql import Window

    return Window.partitionBy("conv_id")
