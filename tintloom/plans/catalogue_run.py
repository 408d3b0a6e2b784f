"""A catalogue run from its inventory to its manifest, committed batch by batch and resumable."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintloom.functions.urls import HostPolicy
from tintloom.operators import runs
from tintloom.operators.runs import PageSource
from tintloom.sources import sinks


def run_catalogue(
    spark: SparkSession, inventory: Callable[[], DataFrame], source: PageSource, policy: HostPolicy, folder: str, identity: dict[str, Any], now: Callable[[], str], interval: int | None = None
) -> dict[str, Any]:
    """The manifest of a run in `folder`, which may hold part of it already.

    Products are worked in batches of `interval` in the order of the inventory, all at once without one; every
    batch is committed. What a former run completed isn't tried again; its inventory is used again.
    """
    target = sinks.RunFolder(spark, folder)
    known = target.inventory()
    products = target.save_inventory(inventory()) if known is None else known
    placed = sinks.batches(products, ["listing_position"], interval) if interval else products.withColumn("batch", F.lit(0))
    for batch in [r["batch"] for r in placed.select("batch").distinct().orderBy("batch").collect()]:
        part, done = placed.where(F.col("batch") == batch).drop("batch"), target.table("completed")
        todo = part if done is None else runs.todo_of(part, done)
        if todo.isEmpty():
            continue
        rows = target.work(runs.attempts(todo, source, policy, target.table("variants"), target.work), "attempts")
        found = runs.tables_of(rows, F.lit(now()))
        for name, key in runs.KEYS.items():
            if (saved := target.table(name)) is not None:
                found[name] = found[name].join(saved.select(key), key, "left_anti")
        target.commit(found, "running")
    tables = {name: target.table(name) for name in sinks.TABLES if name != "collection_products"}
    if tables["products"] is None:  # an inventory without products
        empty = products.limit(0)
        tables = {n: empty.select(*[F.lit(None).cast("string").alias(c) for c in columns]) for n, columns in sinks.TABLES.items() if n != "collection_products"}
    named = products.withColumn("product_id", F.coalesce("product_id", "product_url"))
    result = {**sinks.manifest({**tables, "collection_products": named}, tables["completed"], identity), "finished_at": now()}
    target.finish(result["status"], {k: v for k, v in result.items() if k.endswith("_count")})
    sinks.write_json_file(result, f"{folder}/run_manifest.json")
    return result
