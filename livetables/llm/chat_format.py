"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as
context, that reply as the only trainable text. Turns after the last reply (or
all turns of a conversation without one) go into a last example that trains
nothing, so no turn is lost.

Template. A turn is  <|turn|>role newline text <|end|>  . Texts and roles are
escaped so that no control string can come from them: backslash, `<` and `[`
become a backslash and a letter (`\\b`, `\\l`, `\\k`), and a line break in a role
`\\n`. `unescape` undoes it exactly.

Plan. One shuffle brings the turns of a conversation together (they have to be
one row: an example holds them all); examples are made by exploding the numbers
of the replies, one at a time, so the expansion is never held as a whole.

Defined results: null text or role counts as empty; turns are ordered by (turn,
role, text), null turns first, so repeated rows and ties are kept in a fixed
order; a null conversation id is a conversation; empty tables give no examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livetables.llm.common import col, hex_sha256, text_or_empty

# The control strings and the escapes, in the order of escaping.
TURN, END = "<|turn|>", "<|end|>"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\k"))


def escape(c: Column) -> Column:
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def _role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def _unrole(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\n"), F.lit("\n")))


def expand(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """conversation id, example (from 0), formatted, loss_start, loss_end (code points, end exclusive).

    Only formatted[loss_start:loss_end] is trained; in the last example of a
    conversation that doesn't end with a reply the range is empty.
    """
    turns = df.select(col(conv_col).alias("conv"), F.struct(
        col(turn_col).alias("turn"), text_or_empty(role_col).alias("role"), text_or_empty(text_col).alias("text")).alias("t"))
    whole = (turns.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
             .withColumn("ends", F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (
                 F.element_at("turns", i)["role"] == trained_role) | (i == F.size("turns")))))
    examples = whole.select("conv", "turns", F.posexplode("ends").alias("example", "last"))
    head = F.transform(F.slice("turns", 1, F.col("last") - 1), lambda t: F.concat(
        F.lit(TURN), _role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END)))
    target = F.element_at("turns", F.col("last"))
    examples = examples.select(
        "conv", "example",
        F.concat(F.array_join(head, ""), F.lit(TURN), _role(target["role"]), F.lit("\n")).alias("before"),
        escape(target["text"]).alias("reply"), (target["role"] == trained_role).alias("trained"))
    start = F.length("before")
    return examples.select(
        F.col("conv").alias(conv_col), "example", F.concat("before", "reply", F.lit(END)).alias("formatted"),
        start.alias("loss_start"), (start + F.when(F.col("trained"), F.length("reply")).otherwise(0)).alias("loss_end"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    pieces = F.split(formatted, r"\Q" + END + r"\E", -1)
    bodies = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: p.substr(F.lit(len(TURN) + 1), F.length(p)))
    return F.transform(bodies, lambda b: F.struct(
        _unrole(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(b.substr(F.instr(b, "\n") + F.lit(1), F.length(b))).alias("text")))


def digests(examples: DataFrame, *, conv_col: str = "conv_id") -> DataFrame:
    """What the examples of each conversation say, read back from their formatted texts."""
    masked = F.col("formatted").substr(F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    per = (examples.select(col(conv_col).alias("conv"), "example", "formatted", unescape(masked).alias("loss"))
           .groupBy("conv").agg(F.max_by("formatted", "example").alias("whole"),
                                F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
                                F.sum(F.length("formatted")).cast("long").alias("formatted_chars"))
           .select("conv", parse(F.col("whole")).alias("turns"),
                   F.array_join(F.col("losses.loss"), "").alias("loss"), "formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select(
        F.col("conv").alias(conv_col), F.size("turns").cast("long").alias("n_turns"),
        hex_sha256(told).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        hex_sha256(F.col("loss")).alias("loss_sha256"), "formatted_chars")
