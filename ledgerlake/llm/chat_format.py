"""Preference formatting of chat pairs.

Two conversations answer the same opening: the chosen and the rejected one.
Their longest common prefix of turns (same role and same text) is rendered
once as the prompt; what follows is rendered as two completions.  The masks
say which characters of a completion are trained on: the content and the end
mark of the assistant's turns.

Only DataFrame functions are used.  The turns of one pair are brought together
by one shuffle (a pair becomes one row of text, so its turns have to meet);
everything else is array expressions over that row.

Defined results: turns are ordered by turn, then role, then text, nulls first;
repeated turns stay; a null text is empty, a null role is ``user``; rows
without a pair id belong to no conversation; a pair with one side only has no
row; equal sides give an empty pair of completions; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _turns(side: DataFrame, name: str) -> DataFrame:
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("user")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return (side.where("pair_id is not null").groupBy("pair_id")
            .agg(F.sort_array(F.collect_list(turn)).alias(name)))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t.role, F.lit("\n"), t.text, F.lit(CLOSE))), "")


def _mask(turns: Column) -> Column:
    """Spans [from, to) of characters to train on, as ``from-to`` joined by commas."""
    def add(acc, t):
        begin = acc["at"] + F.length(F.concat(F.lit(OPEN), t.role, F.lit("\n"))).cast("long")
        end = begin + F.length(t.text) + len(CLOSE)
        span = F.concat_ws("-", begin.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t.role == "assistant", F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.array_join(F.aggregate(turns, zero, add)["spans"], ",")


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Turns (pair_id, turn, role, text) of both sides -> pair_id, n_prompt
    (common turns), prompt, chosen, rejected, chosen_mask, rejected_mask."""
    both = _turns(chosen, "c").join(_turns(rejected, "r"), "pair_id")
    same = F.zip_with("c", "r", lambda a, b: F.coalesce((a.role == b.role) & (a.text == b.text), F.lit(False)))
    # turns before the first that differs; where one side ends, the other's next turn differs
    common = F.aggregate(same, F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")),
                         lambda acc, x: F.struct((acc["n"] + (acc["go"] & x).cast("int")).alias("n"), (acc["go"] & x).alias("go")))["n"]
    both = both.withColumn("n_prompt", common)
    rest = {side: F.slice(side, F.col("n_prompt") + 1, F.size(side) + 1) for side in "cr"}
    return both.select("pair_id", "n_prompt", _render(F.slice("c", F.lit(1), F.col("n_prompt"))).alias("prompt"),
                       _render(rest["c"]).alias("chosen"), _render(rest["r"]).alias("rejected"),
                       _mask(rest["c"]).alias("chosen_mask"), _mask(rest["r"]).alias("rejected_mask"))


def reply_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs within conversations (conv_id, turn, role, text): the
    chosen side ends with the last reply of the assistant; the rejected side
    has in its place the assistant's reply before (a stale answer), or without
    one the user's own words.  Rows with a null turn belong to neither side, a
    conversation without an assistant's turn has no pair, and turns after the
    last reply are left out."""
    turns = conversations.select(F.col("conv_id").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    turns = turns.where("pair_id is not null and turn is not null")
    ends = (turns.groupBy("pair_id").agg(F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last"))
            .where("last is not null"))
    upto = turns.join(ends, "pair_id").where("turn <= last")
    last_user = F.max(F.when((F.col("turn") < F.col("last")) & (F.col("role") == "user"), F.struct("turn", "text")))
    stale = F.max(F.when((F.col("turn") < F.col("last")) & (F.col("role") == "assistant"), F.struct("turn", "text")))
    other = (upto.groupBy("pair_id").agg(stale.alias("s"), last_user.alias("u"), F.max("last").alias("turn"))
             .select("pair_id", "turn", F.lit("assistant").alias("role"),
                     F.when(F.col("s").isNotNull(), F.col("s.text")).otherwise(F.col("u.text")).alias("text")))
    columns = ["pair_id", "turn", "role", "text"]
    return upto.select(columns), upto.where("turn < last").select(columns).unionByName(other)
