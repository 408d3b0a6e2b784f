"""Outputs: atomic files on the driver, tables of a run, and its manifest."""

from __future__ import annotations

import csv
import json
import os
from collections.abc import Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintloom.operators import snapshot
from tintloom.sources import files

# The columns of a run's tables, and of a colour run's.
TABLES = {
    "collection_products": ("product_id", "product_url", "listing_page", "listing_position"),
    "products": ("product_id", "brand", "product_name", "product_url", "rating", "review_count"),
    "variants": ("product_id", "sku_id", "variant_type", "variant_name", "variant_description", "variant_url", "list_price", "sale_price", "size_text", "availability", "swatch_image_url", "variant_image_url", "ingredient_set_id"),
    "ingredients": ("product_id", "ingredient_set_id", "ingredients"),
    "failures": ("occurred_at", "stage", "product_id", "url", "error_type", "message"),
    "completed": ("product_id",),
}
COLORS = ("product_id", "sku_id", "swatch_image_url", "image_sha256", "image_width", "image_height", "sample_pixel_count", "rgb_r", "rgb_g", "rgb_b", "hex_color", "lab_l", "lab_a", "lab_b", "rgb_spread", "extraction_method")
COLOR_FAILURES = ("product_id", "sku_id", "swatch_image_url", "error_type", "message")


def replace(path: Path, write) -> None:
    """A file that `write` fills aside and that is then moved into place."""
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary = path.with_name(f".{path.name}.{os.getpid()}.tmp")
    try:
        write(temporary)
        os.replace(temporary, path)
    finally:
        temporary.unlink(missing_ok=True)


def write_csv_file(frame: DataFrame, path: str | Path, fields: Sequence[str]) -> None:
    """One CSV file with a byte order mark, the given columns in order, written aside and moved into place; rows stream through the driver."""

    def write(temporary: Path) -> None:
        with temporary.open("w", encoding="utf-8-sig", newline="") as handle:
            out = csv.writer(handle)
            out.writerow(fields)
            for row in frame.select(*fields).toLocalIterator():
                out.writerow(["" if v is None else v for v in row])

    replace(Path(path), write)


def write_json_file(value: Any, path: str | Path) -> None:
    replace(Path(path), lambda t: t.write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8"))


def write_text_file(value: str, path: str | Path) -> None:
    replace(Path(path), lambda t: t.write_text(value, encoding="utf-8"))


class RunFolder:
    """The tables of a run, written part by part.

    A part is a folder below each table's. It counts only once `checkpoint.json`, which is replaced as a whole,
    lists it: whoever reads in between, or after a crash, sees the last state that was committed.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.state: dict[str, Any] = files.json_document(spark, f"{folder}/checkpoint.json")

    def table(self, name: str) -> DataFrame | None:
        """The committed rows of a table; none before the first commit."""
        parts = self.state.get("parts", [])
        return self.spark.read.parquet(*[f"{self.folder}/{name}/{p}" for p in parts]) if parts else None

    def inventory(self) -> DataFrame | None:
        path = f"{self.folder}/collection_products"
        return self.spark.read.parquet(path) if files.exists(self.spark, f"{path}/_SUCCESS") else None

    def save_inventory(self, frame: DataFrame) -> DataFrame:
        frame.select(*TABLES["collection_products"]).write.mode("overwrite").parquet(f"{self.folder}/collection_products")
        return self.inventory()

    def work(self, frame: DataFrame, name: str) -> DataFrame:
        """A frame that several tables are made of, kept until the next commit."""
        path = f"{self.folder}/_work/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def commit(self, tables: dict[str, DataFrame], state: str) -> None:
        part = f"part-{len(self.state.get('parts', [])):05d}"
        for name, frame in tables.items():
            frame.select(*TABLES[name]).write.mode("overwrite").parquet(f"{self.folder}/{name}/{part}")
        self.state = {**self.state, "state": state, "parts": [*self.state.get("parts", []), part]}
        write_json_file(self.state, f"{self.folder}/checkpoint.json")
        work = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/_work")
        work.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(work, True)

    def finish(self, state: str, counts: dict[str, Any]) -> None:
        """The last state, with the completed ids in order."""
        done = self.table("completed")
        ids = [] if done is None else [r[0] for r in done.distinct().orderBy("product_id").toLocalIterator()]
        self.state = {**self.state, **counts, "state": state, "completed_product_ids": ids}
        write_json_file(self.state, f"{self.folder}/checkpoint.json")


def manifest(tables: dict[str, DataFrame], completed: DataFrame, identity: dict[str, Any]) -> dict[str, Any]:
    """Identity and counters of a run, with its status."""
    counts = snapshot.run_counts(tables["collection_products"], completed, tables["variants"], tables["ingredients"], tables["failures"]).first().asDict()
    named = {
        "inventory_product_count": counts["inventory"], "completed_product_count": counts["completed"], "product_count": tables["products"].count(), "variant_count": counts["variants"], "ingredient_set_count": counts["ingredient_sets"],
        "variant_without_ingredients_count": counts["variants_without_ingredients"], "failure_attempt_count": counts["failures"], "unresolved_product_count": counts["unresolved"],
    }
    return {**identity, "encoding": {"html": "strict, UTF-8 first", "unicode_normalization": "NFC", "csv": "utf-8-sig", "json": "utf-8"}, "raw_fields": {n: list(c) for n, c in TABLES.items()}, **counts, **named}


def check_resume(saved: dict[str, Any], identity: dict[str, Any], keys: Sequence[str] = ("schema_version", "collection", "source_url")) -> None:
    """Raises unless a saved run is of the same schema, collection and source."""
    if wrong := [k for k in keys if saved.get(k) != identity.get(k)]:
        raise snapshot.ContractError(f"the saved run differs in {', '.join(wrong)}")


def batches(frame: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Rows with the number of the checkpoint they belong to: the first `size` in order 0, the next 1, and so on."""
    return snapshot.positions(frame, order, "__p").withColumn("batch", F.floor((F.col("__p") - 1) / size)).drop("__p")
