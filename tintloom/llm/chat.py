"""Chat formatting: collapse of cumulative snapshots, then rendering.

A chat service logs a conversation again after each turn, so most logged conversations are prefixes of a
longer one. The turns of a conversation get rolling hashes of everything up to each turn. A conversation
whose whole hash is a shorter prefix of another falls to an anti-join; of equal ones the smallest id stays.
The joins run on distinct hashes, so a first turn or conversation that a third of the log shares is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A turn's hash keeps so many bits in each of two sums; 2^62 / 2^40 turns can't overflow them.
HASH_BITS = 40
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _escaped(text: Column) -> Column:
    """Text in which the template's marks have a blank, so that it can't open or close a turn."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rolling_prefixes(turns: DataFrame) -> DataFrame:
    """The turns with `k` (1, 2, ...), `p1`, `p2` (hashes of turns 1 to k) and `n_turns` of their conversation.

    The hash of a turn depends on its position, role and text; the prefix's is the sum of those, kept as two
    sums of 40 bits. Both are window sums: one pass over the sorted conversation that spills if it must.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    known = turns.where("conv_id is not null").select("conv_id", "turn", "role", "text")
    seen = F.lag(F.struct("turn", "role", "text")).over(order)
    numbered = known.withColumn("__same", F.struct("turn", "role", "text").eqNullSafe(seen)).where("not __same").withColumn("k", F.row_number().over(order).cast("long"))
    to_here = order.rowsBetween(Window.unboundedPreceding, 0)
    value = [F.coalesce(c, F.lit("")) for c in (F.col("role"), F.col("text"))]
    part = lambda seed: F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("k"), *value), 64 - HASH_BITS)
    return numbered.select(
        "conv_id", "k", "role", "text",
        F.sum(part("a")).over(to_here).alias("p1"),
        F.sum(part("b")).over(to_here).alias("p2"),
        F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n_turns"),
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal) of the conversations that no longer one begins with; of equal ones the smallest id."""
    whole = prefixes.where("k = n_turns").groupBy("k", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    inner = prefixes.where("k < n_turns").select("k", "p1", "p2").distinct()
    return whole.join(inner, ["k", "p1", "p2"], "left_anti").select("conv_id", F.col("k").alias("n_turns"), "n_equal")


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal, text): every maximal conversation, rendered turn by turn.

    Turns are ordered by turn, role and text; a row repeated as a whole counts once. A null role or text is
    empty. Rows without a conv_id belong to no conversation and give none. `n_equal` is the number of
    conversations with just these turns. An empty table gives no rows; further columns are left out.
    """
    prefixes = rolling_prefixes(turns)
    kept = maximal_conversations(prefixes)
    line = F.concat(F.lit(OPEN), _escaped(F.col("role")), F.lit("\n"), _escaped(F.col("text")), F.lit(CLOSE + "\n"))
    parts = prefixes.select("conv_id", "k", line.alias("line")).join(kept, "conv_id")
    return (
        parts.groupBy("conv_id", "n_turns", "n_equal")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "").alias("text"))
        .select("conv_id", "n_turns", "n_equal", "text")
    )
