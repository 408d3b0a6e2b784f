"""Tables and documents from files."""

from __future__ import annotations

import json
import re
import tempfile
from collections.abc import Sequence
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tintloom.functions import text, urls
from tintloom.operators import snapshot


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scratch(spark: SparkSession) -> Path:
    """A new folder for files: below the one that all machines share, or a temporary one in local mode."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    base = re.sub("^file:/+", "/", shared) if shared else None
    return Path(tempfile.mkdtemp(prefix="tintloom-", dir=base))


def csv_rows(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """A CSV file with header as texts, empty cells null, a byte order mark skipped; without a file an empty table of `columns`."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)


def csv_table(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """A CSV file that must be there and have the columns; it may have more."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return snapshot.require_columns(csv_rows(spark, path), required, path)


def json_document(spark: SparkSession, path: str) -> dict[str, Any]:
    """A small JSON object; without a file an empty one."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if exists(spark, path) else {}


def swatch_input(frame: DataFrame, policy: urls.HostPolicy, place: str | None = None) -> DataFrame:
    """The first row of each SKU: sku_id and swatch_image_url trimmed; raises for empty ones, other hosts, and a SKU with two URLs.

    A column `place`, if named, tells the order of the rows. Places follow the rows of a file that one task reads, as CSV files with line breaks in cells are.
    """
    snapshot.require_columns(frame, ("sku_id", "swatch_image_url"), "swatch input")
    rows = frame.withColumns({"sku_id": text.strip(F.col("sku_id")), "swatch_image_url": text.strip(F.col("swatch_image_url")), "__ord": F.monotonically_increasing_id()})
    empty = (F.coalesce("sku_id", F.lit("")) == "") | (F.coalesce("swatch_image_url", F.lit("")) == "")
    audit = rows.agg(F.count_if(empty).alias("empty"), F.count_if(~empty & ~urls.is_swatch_url(F.col("swatch_image_url"), policy)).alias("host"), F.min(F.when(empty, F.col("__ord"))).alias("at")).first()
    if audit["empty"]:
        raise snapshot.ContractError(f"{audit['empty']} rows without SKU or URL, the first is data row {audit['at'] + 2}")
    if audit["host"]:
        raise snapshot.ContractError(f"{audit['host']} swatch URLs aren't https addresses of {policy.media_host}")
    if conflict := snapshot.key_conflicts(rows, "sku_id", "swatch_image_url").first():
        raise snapshot.ContractError(f"SKU {conflict['sku_id']} has {conflict['n_values']} URLs")
    first = snapshot.keep_first(rows, ["sku_id"], ["__ord"])
    return first.withColumnRenamed("__ord", place) if place else first.drop("__ord")


def product_list(spark: SparkSession, addresses: Sequence[str], policy: urls.HostPolicy) -> DataFrame:
    """(product_id, product_url, listing_page, listing_position) of explicit product addresses, the first of each product."""
    frame = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "ord int, url string")
    known = frame.select("ord", urls.without_query(urls.normalized(F.col("url"), F.lit(f"https://{policy.canonical}"), policy)).alias("product_url"))
    found = known.withColumn("product_id", urls.product_token(F.col("product_url"))).withColumn("k", F.lower(F.coalesce("product_id", "product_url")))
    firsts = snapshot.keep_first(found.where("product_id is not null"), ["k"], ["ord"])
    return snapshot.positions(firsts, ["ord"], "listing_position").select("product_id", "product_url", F.lit(None).cast("string").alias("listing_page"), "listing_position")


def declared_charset(content_type: Column) -> Column:
    return text.none_if_empty(F.lower(F.regexp_extract(F.coalesce(content_type, F.lit("")), r"(?i)charset\s*=\s*[\"']?([\w.:-]+)", 1)))


@F.pandas_udf(T.StringType())
def _decoded(content: pd.Series, charset: pd.Series, apparent: pd.Series) -> pd.Series:
    def one(data, names):
        if data is None:
            return None
        for name in dict.fromkeys(n.lower() for n in names if n):
            try:
                return bytes(data).decode(name)
            except (LookupError, UnicodeDecodeError):
                continue
        return None

    return pd.Series([one(d, (c, a)) for d, c, a in zip(content, charset, apparent)])


def decoded_html(content: Column, charset: Column, apparent: Column | None = None) -> Column:
    """Bytes as text in form C: UTF-8, else the declared charset, else the apparent one; null if none fits. Only bytes that aren't UTF-8 leave the JVM."""
    utf8 = F.try_validate_utf8(content.cast("string"))
    rest = F.when(utf8.isNull(), content)
    return text.nfc(F.coalesce(utf8, _decoded(rest, charset, apparent if apparent is not None else F.lit(None).cast("string"))))
