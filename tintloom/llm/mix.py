"""Mixing sources to target weights.

Sizes are summed per source, targets follow from the weights, and rate = target / source size says how often
a document of the source is taken: floor(rate) times, and once more with probability equal to the fraction,
drawn from a hash of seed, document id and text. Only one row per source is ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tintloom.llm.common import WORD, stored

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2, "mix-1"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code point order, null last, weigh `weights` in turn and share `share` times all sizes. A
    target stops at `most` times its source's size and the excess is shared again by weight: in order of
    cap / weight, a source is capped if what is left for it and those after it would exceed its cap. The
    windows run over one row per source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").cast("double").alias("s"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sums.withColumn("w", weight).withColumn("c", F.col("s") * float(most))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("c") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = (
        weighed.withColumn("t", F.sum("s").over(everything) * float(share))
        .withColumn("all_w", F.sum("w").over(everything))
        .withColumn("c0", F.coalesce(F.sum("c").over(before), F.lit(0.0)))
        .withColumn("w0", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("capped", F.col("c") * (F.col("all_w") - F.col("w0")) <= F.col("w") * (F.col("t") - F.col("c0")))
    )
    spent = F.sum(F.when(F.col("capped"), F.col("c")).otherwise(0.0)).over(everything)
    open_w = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("w"))).over(everything)
    target = F.when(F.col("capped"), F.col("c")).otherwise(F.col("w") * (F.col("t") - spent) / F.when(open_w > 0, open_w))
    return left.select("source", F.col("s").cast("long").alias("source_size"), target.alias("target"))


def draw(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed and keys; equal keys draw the same."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """`docs` with __size, __source_size, __target and __copies (how often the mix takes the row).

    A null text has size 0, a null source is a source of its own. Rows that share an id, or have none, are
    drawn by their texts; rows alike in both are drawn alike. A source whose documents are all empty has
    rate 0. No rows give no rows.
    """
    sized = docs.withColumn("__size", word_count(F.col("text")))
    targets = stored(source_targets(sized.select("source", F.col("__size").alias("size")), weights, share, most), "targets")
    targets = targets.select(F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"))
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0)
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("__source")), "inner").drop("__source")
    extra = (draw(seed, F.col("doc_id"), F.md5("text")) < rate - F.floor(rate)).cast("long")
    return joined.withColumn("__copies", F.floor(rate) + extra)


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents: each row of `docs` as often as the plan takes it, with the columns of `docs`."""
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("__row"))
    planned = plan_mix(rows, **settings).where("__copies > 0")
    return planned.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select("__row.*")
