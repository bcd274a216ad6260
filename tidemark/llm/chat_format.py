"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns is rendered once, as the prompt; what is left
of either conversation is its completion, with the spans that a loss may count
(what the assistant says there, with the end mark). Built-in expressions over
one row a pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
END = "\n<|end|>\n"
TURN = "struct<role:string,text:string>"


def gather_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", out_col: str = "turns") -> DataFrame:
    """(id, turns): each conversation as an array of (role, text) by turn
    number; null numbers first, ties by role and text. Null roles and texts
    become empty. Rows with a null id belong to no conversation that could be
    told apart: each is one of its own, of one turn, and is never gathered."""
    turn = F.struct(F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = F.array_sort(F.collect_list(F.struct(F.col(turn_col).alias("turn"), turn.alias("said"))))
    told = F.col(id_col).isNotNull()
    gathered = (df.where(told).groupBy(F.col(id_col).alias(id_col))
                .agg(F.transform(rows, lambda t: t["said"]).alias(out_col)))
    return gathered.unionByName(df.where(~told).select(F.col(id_col), F.array(turn).alias(out_col)))


def common_turns(a: Column, b: Column) -> Column:
    """Number of turns that two conversations have in common from the start."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def render(turns: Column) -> Column:
    """The text of some turns, in the template of this module."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def loss_spans(turns: Column) -> Column:
    """(start, stop) code points of the assistant's words in ``render(turns)``,
    from after the head to the end mark's end."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(acc, t):
        begin = acc["at"] + F.length(_head(t))
        stop = begin + F.length(t["text"]) + len(END)
        own = F.array(F.struct(begin.alias("start"), stop.alias("stop")))
        spans = F.when(t["role"] == ASSISTANT, F.concat(acc["spans"], own)).otherwise(acc["spans"])
        return F.struct(stop.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_preferences(df: DataFrame, chosen_col: str = "chosen", rejected_col: str = "rejected") -> DataFrame:
    """``df`` with its two conversations (arrays of ``TURN``) replaced by
    n_common, prompt, chosen, rejected, chosen_spans, rejected_spans, usable.

    Defined cases: a null conversation counts as one without turns; if one
    conversation is a prefix of the other its completion is empty; equal
    conversations leave two empty completions; ``usable`` is true where both
    completions have a span. Texts are rendered as they are, marks included.
    Equal rows and columns of any other name pass through; an empty table gives
    no rows.
    """
    empty = F.array().cast(f"array<{TURN}>")
    sides = df.withColumn("__a", F.coalesce(F.col(chosen_col).cast(f"array<{TURN}>"), empty)) \
        .withColumn("__b", F.coalesce(F.col(rejected_col).cast(f"array<{TURN}>"), empty))
    kept = [c for c in df.columns if c not in (chosen_col, rejected_col)]
    sides = sides.withColumn("__n", common_turns(F.col("__a"), F.col("__b")))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("__n") + 1, F.size(side))

    out = sides.select(
        *[F.col(f"`{c}`") for c in kept], F.col("__n").alias("n_common"),
        render(F.slice("__a", 1, F.col("__n"))).alias("prompt"),
        render(rest("__a")).alias(chosen_col), render(rest("__b")).alias(rejected_col),
        loss_spans(rest("__a")).alias(f"{chosen_col}_spans"), loss_spans(rest("__b")).alias(f"{rejected_col}_spans"))
    return out.withColumn("usable", (F.size(f"{chosen_col}_spans") > 0) & (F.size(f"{rejected_col}_spans") > 0))
