"""New pages as a stream: files of (url, html, fetched_at) that arrive are parsed once per address."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tintloom.functions.urls import HostPolicy
from tintloom.operators.product_pages import product_rows, raw_pages

SCHEMA = "url string, html string, fetched_at timestamp"


def new_pages(spark: SparkSession, folder: str, lateness: str = "1 day") -> DataFrame:
    """Pages of Parquet files in `folder`; an address that comes again within the lateness is left out, so state stays bounded."""
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    return stream.withWatermark("fetched_at", lateness).dropDuplicatesWithinWatermark(["url"])


def parse_stream(spark: SparkSession, folder: str, output: str, checkpoint: str, policy: HostPolicy, **trigger):
    """Writes parsed products of new pages to `output`; a restart goes on where the checkpoint stands."""
    parsed = product_rows(raw_pages(new_pages(spark, folder)), policy)
    return parsed.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()
