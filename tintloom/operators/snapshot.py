"""Snapshot algebra: keep-first tables, audited joins, resume, positions, manifests."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def beside(frame: DataFrame) -> DataFrame:
    """A side of a join that grows with the input, so it is never sent to the driver and all executors: both sides are dealt and merged.

    Spark's own choice goes by estimates, which take any text for 20 bytes and stored tables for their compressed size.
    """
    return frame.hint("merge")


#: Rows of the sample that `positions` takes its bounds from, for each of its ranges.
SAMPLED = 100


class ContractError(ValueError):
    """A table doesn't satisfy what is asked of it."""


def keep_first(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the rows with equal keys the first in `order`: an aggregation, combined before its one shuffle."""
    row = F.min_by(F.struct(*frame.columns), F.struct(*order))
    return frame.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(row.alias("__row")).select("__row.*")


def positions(frame: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """The rows numbered 1, 2, ... in `order`, without bringing them together.

    Rows are cut into ranges by bounds from a sample, taken once: a row's number is its place in its range after the
    sizes of the ranges before, and only these sizes are summed in one place. Which range a row is in follows from
    the row alone, so sizes and places agree however often Spark reads or deals the rows.
    """
    cols = [F.col(c) for c in order]
    key = F.struct(*cols)
    count = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = frame.select(*cols).schema.fields
    drawn = frame.select(key.alias("k")).orderBy(F.rand(1)).limit(count * SAMPLED).agg(F.array_sort(F.collect_set("k"))).first()[0]
    bounds = [drawn[i * len(drawn) // count] for i in range(1, count)] if len(drawn) > count else drawn[1:]
    dealt = frame.withColumn("__part", F.lit(0))
    if bounds:
        held = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, kinds, strict=True)]) for b in bounds])
        dealt = frame.withColumn("__part", F.size(F.filter(held, lambda b: b <= key)))
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    placed = dealt.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy(*cols)))
    return placed.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def first_n(frame: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows in `order`."""
    return frame.orderBy(*order).limit(n)


def unresolved(inventory: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    """What of the inventory isn't completed."""
    return inventory.join(beside(completed.select(key).distinct()), key, "left_anti")


def completed_of(inventory: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    return inventory.join(beside(completed.select(key).distinct()), key, "left_semi")


def stale_keys(saved: DataFrame, selected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of a saved output that the present selection doesn't have."""
    return saved.select(*keys).distinct().join(beside(selected.select(*keys).distinct()), list(keys), "left_anti")


def missing_columns(frame: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(frame.columns))


def require_columns(frame: DataFrame, required: Sequence[str], what: str) -> DataFrame:
    if missing := missing_columns(frame, required):
        raise ContractError(f"{what} lacks columns: {', '.join(missing)}")
    return frame


def key_conflicts(frame: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with several values."""
    return frame.groupBy(key).agg(F.count_distinct(value).alias("n_values")).where("n_values > 1")


def join_audit(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: empty and repeated keys of both sides, and keys of one side alone."""
    sides = [f.select(F.trim(F.col(key).cast("string")).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias(n)) for f, n in ((left, "l"), (right, "r"))]
    both = sides[0].join(beside(sides[1]), "k", "full_outer")
    empty = F.coalesce(F.col("k"), F.lit("")) == ""
    count = lambda c: F.count_if(c)
    return both.agg(
        count(empty).alias("empty_keys"),
        count((F.col("l") > 1) & ~empty).alias("left_repeated"),
        count((F.col("r") > 1) & ~empty).alias("right_repeated"),
        count(F.col("r").isNull() & ~empty).alias("left_only"),
        count(F.col("l").isNull() & ~empty).alias("right_only"),
    )


def strict_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One-to-one join on the trimmed key; raises if a key is empty, repeated, or on one side alone.

    Columns of both sides come from the right one, the key included.
    """
    audit = join_audit(left, right, key).first().asDict()
    if wrong := {k: n for k, n in audit.items() if n}:
        raise ContractError(f"keys of {key} don't match one to one: {wrong}")
    return right_biased(left, right, key)


def right_biased(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on the trimmed key in which the right side's columns win."""
    a = left.withColumn("__key", F.trim(F.col(key).cast("string")))
    b = right.withColumn("__key", F.trim(F.col(key).cast("string")))
    own = [c for c in left.columns if c not in right.columns]
    return a.select("__key", *own).join(beside(b), "__key").select(*own, *right.columns)


def resume_union(saved: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Saved rows, and the new ones whose keys aren't saved."""
    return saved.unionByName(new.join(beside(saved.select(*keys).distinct()), list(keys), "left_anti"))


def run_counts(inventory: DataFrame, completed: DataFrame, variants: DataFrame, ingredients: DataFrame, failures: DataFrame, key: str = "product_id") -> DataFrame:
    """One row of counters and the status of a run; completed products outside the inventory don't count."""
    done = completed_of(inventory.select(key).distinct(), completed, key)
    count = lambda f, n: f.agg(F.count(F.lit(1)).alias(n))
    parts = [
        count(inventory.select(key).distinct(), "inventory"), count(done, "completed"),
        variants.agg(F.count(F.lit(1)).alias("variants"), F.count_if(F.coalesce(F.col("ingredient_set_id"), F.lit("")) == "").alias("variants_without_ingredients")),
        count(ingredients, "ingredient_sets"), count(failures, "failures"),
    ]
    row = parts[0]
    for part in parts[1:]:
        row = row.crossJoin(part)  # of single rows
    return row.withColumn("unresolved", F.col("inventory") - F.col("completed")).withColumn("status", run_status(F.col("completed"), F.col("inventory")))


def run_status(completed: Column, inventory: Column) -> Column:
    return F.when(completed == inventory, "complete").otherwise("partial")


def failures_of(outcomes: DataFrame, stage: str | Column, occurred_at: Column) -> DataFrame:
    """Rows of the attempt log from outcomes (product_id, url, error_type, message) that have an error."""
    return outcomes.where("error_type is not null").select(
        occurred_at.alias("occurred_at"), (F.lit(stage) if isinstance(stage, str) else stage).alias("stage"), "product_id", "url", "error_type", F.left(F.col("message"), F.lit(1000)).alias("message")
    )


def pagination_from(pages: DataFrame, starts: DataFrame, max_pages: int = 100) -> DataFrame:
    """(start, url, page_no) of the pages reached from each start by their `next` links: no page twice, at most max_pages.

    `pages` has url and next, `starts` has start. Every hop is one join of all chains with the pages.
    """
    spark, names = pages.sparkSession, [f"{n}_{uuid.uuid4().hex}" for n in ("pages", "starts")]
    pages.select("url", "next").createOrReplaceTempView(names[0])
    starts.select("start").createOrReplaceTempView(names[1])
    try:
        return spark.sql(
            f"""WITH RECURSIVE chain(start, url, next, page_no, seen) MAX RECURSION LEVEL {max_pages + 1} AS (
              SELECT s.start, p.url, p.next, 1, array(p.url) FROM {names[1]} s JOIN {names[0]} p ON p.url = s.start
              UNION ALL
              SELECT c.start, p.url, p.next, c.page_no + 1, array_append(c.seen, p.url)
              FROM chain c JOIN {names[0]} p ON p.url = c.next WHERE c.page_no < {max_pages} AND NOT array_contains(c.seen, p.url))
            SELECT start, url, page_no FROM chain"""
        )
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


def pagination(pages: DataFrame, start: str, max_pages: int = 100) -> DataFrame:
    """(url, page_no) of the chain from one start; a page whose products (column product_ids, if there) all came on pages before it is the last."""
    spark = pages.sparkSession
    chain = pagination_from(pages, spark.createDataFrame([(start,)], "start string"), max_pages).select("url", "page_no")
    if "product_ids" not in pages.columns:
        return chain
    # At most max_pages rows; walked once, not again for each use below.
    chain = spark.createDataFrame(chain.collect(), chain.schema)
    listed = chain.join(pages.select("url", F.explode("product_ids").alias("id")), "url")
    fresh = listed.groupBy(F.lower("id").alias("id")).agg(F.min("page_no").alias("page_no")).groupBy("page_no").agg(F.count(F.lit(1)).alias("fresh"))
    stop = chain.join(fresh, "page_no", "left").where("fresh is null").agg(F.coalesce(F.min("page_no"), F.lit(max_pages)).alias("stop"))
    return chain.crossJoin(stop).where("page_no <= stop").select("url", "page_no")
