"""Chat formatting by prefix-target expansion, in DataFrame operations only.

Every assistant turn becomes an example of its own: all turns before it are context, and its text alone is trainable.
The template marks a turn as <|turn|>ROLE<|text|>TEXT<|end|>. In roles and texts a backslash is doubled and `<|` becomes
`<\\|`, so no control string can stand inside them, and both steps can be taken back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def chat_examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target: str = "assistant") -> DataFrame:
    """conv, example (position of its last turn), formatted, loss_start, loss_chars (both in code points of formatted).

    Turns go by number; turns that share a number, by role and text, and repeated rows stay. A null number comes first.
    Null roles and texts are empty. Turns after the last reply (or all, if there is no reply) give one more example with
    loss_chars 0, so that nothing is lost. A row with a null conv is a conversation of its own. Every example holds the
    whole conversation up to its reply, so a conversation has to fit in a row. Other columns are not read; no rows give
    no rows.
    """
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv).alias("conv"), F.when(F.col(conv).isNull(), F.monotonically_increasing_id()).alias("alone"), F.struct(F.col(turn).alias("turn"), none(role).alias("role"), none(text).alias("text")).alias("t"))
    whole = rows.groupBy("conv", "alone").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    head = lambda t: F.concat(F.lit(TURN), escaped(t["role"]), F.lit(TEXT))
    whole = whole.select(
        "conv", "alone", "ts",
        F.transform("ts", lambda t: F.concat(head(t), escaped(t["text"]), F.lit(END))).alias("parts"),
        F.filter(F.sequence(F.lit(0), F.size("ts") - 1), lambda i: (F.get("ts", i)["role"] == target) | (i == F.size("ts") - 1)).alias("at"),
    )
    one = whole.select("conv", "alone", "parts", F.explode("at").alias("example"), "ts")
    last = F.get("ts", F.col("example"))
    one = one.select("conv", "alone", "example", F.array_join(F.slice("parts", F.lit(1), F.col("example")), "").alias("context"), F.get("parts", F.col("example")).alias("own"), head(last).alias("head"), (last["role"] == target).alias("trains"))
    start = F.length("context") + F.length("head")
    chars = F.when(F.col("trains"), F.length("own") - F.length("head") - len(END)).otherwise(0)
    return one.select(F.col("conv").alias(conv), "alone", F.col("example").cast("long"), F.concat("context", "own").alias("formatted"), start.cast("long").alias("loss_start"), chars.cast("long").alias("loss_chars"))


def read_back(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation, from the examples alone: conv, turns (array of role and text), loss_text, formatted_chars.

    Roles and texts that were null come back as empty ones, as chat_examples writes them; rows without a conversation's id
    come back each by itself; empty texts are turns as others; no examples give no rows."""
    loss = F.when(F.col("loss_chars") > 0, unescaped(F.substr("formatted", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int")))).otherwise("")
    whole = examples.groupBy(conv, "alone").agg(
        F.max_by("formatted", "example").alias("longest"), F.sort_array(F.collect_list(F.struct("example", loss.alias("loss")))).alias("losses"), F.sum(F.length("formatted")).cast("long").alias("formatted_chars")
    )
    parts = F.slice(F.split("longest", r"<\|turn\|>"), 2, F.size(F.split("longest", r"<\|turn\|>")) - 1)
    turn = lambda p: F.struct(
        unescaped(F.substring_index(p, TEXT, 1)).alias("role"),
        unescaped(F.substring(p, F.instr(p, TEXT) + len(TEXT), F.length(p) - F.instr(p, TEXT) - len(TEXT) + 1 - len(END))).alias("text"),
    )
    return whole.select(conv, F.transform(parts, turn).alias("turns"), F.array_join(F.col("losses.loss"), "").alias("loss_text"), "formatted_chars")
