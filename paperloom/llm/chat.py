"""Preference formatting of chosen and rejected conversations.

The two sides of a pair are aligned turn by turn. The longest common prefix of
turns (role and text) is rendered once, as the prompt; what follows on either side is
its completion, in which the loss mask covers the assistant's turns and nothing else.
The alignment is a join on (pair, turn number, tie number) and the prefix length a minimum
over mismatches, so that no conversation is ever gathered in one task: the result
is one row per rendered turn.

Turns are ordered by their number. Rows that repeat a turn number of a
conversation are ties, ordered by role and text, exact repeats included. Null roles
render as ``user`` and null texts as empty; rows without a conversation id or turn
number cannot be placed and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def numbered(turns: DataFrame) -> DataFrame:
    """pair_key columns as they come, with role and text made non-null and ties numbered."""
    clean = turns.withColumns({"role": F.coalesce("role", F.lit("user")), "text": F.coalesce("text", F.lit(""))})
    tie = F.row_number().over(Window.partitionBy("pair_id", "side", "turn").orderBy("role", "text"))
    return clean.withColumn("tie", tie)


def format_pairs(turns: DataFrame) -> DataFrame:
    """``turns``: pair_id, side (chosen or rejected), turn, role, text.

    Returns pair_id, part (prompt, chosen, rejected), turn, tie, rendered text and masked
    (true where the loss counts). Prompt turns appear once.
    """
    rows = numbered(turns.select("pair_id", "side", "turn", "role", "text").where("pair_id is not null and turn is not null"))
    key = ["pair_id", "turn", "tie"]
    rendered = rows.select(*key, "side", "role", render(F.col("role"), F.col("text")).alias("rendered"))
    side = lambda s: F.max(F.when(F.col("side") == s, F.struct("rendered", "role")))
    both = rendered.groupBy(*key).agg(side("chosen").alias("c"), side("rejected").alias("r"))
    differ = ~F.col("c.rendered").eqNullSafe(F.col("r.rendered"))
    first = both.where(differ).groupBy("pair_id").agg(F.min(F.struct("turn", "tie")).alias("__first"))
    placed = both.join(first, "pair_id", "left")
    shared = F.col("__first").isNull() | (F.struct("turn", "tie") < F.col("__first"))
    part = lambda name, x: F.when(x.isNotNull(), F.struct(F.lit(name).alias("part"), x["rendered"].alias("rendered"), (F.lit(name != "prompt") & (x["role"] == "assistant")).alias("masked")))
    parts = F.when(shared, F.array(part("prompt", F.col("c")))).otherwise(F.array_compact(F.array(part("chosen", F.col("c")), part("rejected", F.col("r")))))
    return placed.select(*key, F.explode(parts).alias("p")).select("pair_id", "p.part", "turn", "tie", "p.rendered", "p.masked")


def neighbours_as_pairs(conversations: DataFrame) -> DataFrame:
    """Conversations 2k (chosen) and 2k+1 (rejected) as pair k."""
    return conversations.select(
        F.expr("conv_id div 2").alias("pair_id"),
        F.when(F.pmod(F.col("conv_id"), F.lit(2)) == 0, "chosen").otherwise("rejected").alias("side"),
        "turn", "role", "text",
    )
