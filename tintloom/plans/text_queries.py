"""Queries for text, number, price and label rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tintloom.functions import text
from tintloom.plans.tables import Registry, read

R = Registry()


@R.query(r"SELECT doc_id, nullif(nfc_normalize(regexp_replace(text, '^\s+|\s+$', '', 'g')), '') AS text FROM documents")
def optional_text_nfc(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.optional_text(F.col("text")).alias("text"))


@R.query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_name || ' - ' || p_brand || '!' END AS name FROM part")
def suffix_strip(spark, sf_dir):
    shown = F.concat("p_name", F.lit(" - "), F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.concat("p_brand", F.lit("!"))))
    return read(spark, sf_dir, "part").select("p_partkey", text.without_suffix(shown, F.concat(F.lit(" - "), F.col("p_brand"))).alias("name"))


@R.query("SELECT p_partkey, trim(p_type || '  ' || p_size) AS ingredients, p_name AS heading FROM part")
def prefix_strip(spark, sf_dir):
    listed = F.concat(F.lit(" Ingredients : "), F.col("p_type"), F.lit("  "), F.col("p_size"))
    heading = text.product_name(F.lit(None).cast("string"), F.lit(None).cast("string"), F.concat(F.upper("p_brand"), F.lit(" "), F.col("p_name")), F.col("p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", text.ingredient_text(listed).alias("ingredients"), heading.alias("heading"))


@R.query("SELECT l_orderkey, l_linenumber, l_extendedprice AS price, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS quantity FROM lineitem")
def float_or_none(spark, sf_dir):
    priced = F.concat(F.lit(" $"), F.regexp_replace(F.format_number("l_extendedprice", 4), r"\.?0+$", ""), F.lit(" "))
    quantity = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("string")).otherwise(F.concat(F.col("l_quantity").cast("string"), F.lit("d")))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.number(priced).alias("price"), text.number(quantity).alias("quantity"))


PRICING_SQL = "CASE l_linenumber % 3 WHEN 0 THEN 'Sale Price $' || cents || ' Regularly $' || cents + 1 WHEN 1 THEN 'sale  price ' || cents || '.50' ELSE 'From $' || cents END"


@R.query(rf"""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity, floor(l_extendedprice / 100)::BIGINT AS cents FROM lineitem), p AS (SELECT *, {PRICING_SQL} AS s FROM t)
  SELECT l_orderkey, l_linenumber, coalesce(try_cast(nullif(regexp_extract(s, '(?i)(?:regularly|list\s+price|reg)\s*\$?\s*(\d+(?:\.\d{{1,2}})?)', 1), '') AS DOUBLE), l_quantity) AS list_price,
         try_cast(nullif(regexp_extract(s, '(?i)sale\s+price\s*\$?\s*(\d+(?:\.\d{{1,2}})?)', 1), '') AS DOUBLE) AS sale_price FROM p""")
def money_prices(spark, sf_dir):
    cents = F.floor(F.col("l_extendedprice") / 100).cast("long").cast("string")
    more = (F.floor(F.col("l_extendedprice") / 100).cast("long") + 1).cast("string")
    pricing = (
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("Sale Price $"), cents, F.lit(" Regularly $"), more))
        .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("sale  price "), cents, F.lit(".50")))
        .otherwise(F.concat(F.lit("From $"), cents))
    )
    found = read(spark, sf_dir, "lineitem").withColumn("p", text.prices(pricing, F.col("l_quantity").cast("string")))
    return found.select("l_orderkey", "l_linenumber", "p.list_price", "p.sale_price")


@R.query("SELECT p_partkey, p_retailprice AS rating, CASE WHEN p_partkey % 5 > 0 THEN p_partkey * 1000 + p_size END::INT AS review_count FROM part")
def rating_reviews(spark, sf_dir):
    n = F.col("p_partkey") * 1000 + F.col("p_size")
    reviews = F.when(F.col("p_partkey") % 5 > 0, F.regexp_replace(F.format_number(n, 0), "$", " ")).otherwise(F.lit("many"))
    found = read(spark, sf_dir, "part").withColumn("r", text.rating(F.col("p_retailprice").cast("string"), reviews))
    return found.select("p_partkey", "r.rating", "r.review_count")


@R.query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Color: ' || p_type ELSE p_size || ' oz' END AS size FROM part")
def size_text_parse(spark, sf_dir):
    shown = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Color: "), F.col("p_type"))).otherwise(F.concat(F.lit("Pick a SIZE:  "), F.col("p_size"), F.lit(" oz")))
    return read(spark, sf_dir, "part").select("p_partkey", text.size_text(shown).alias("size"))


@R.query("SELECT p_partkey, ['color', 'size', 'scent', 'default', 'color'][(p_partkey % 5 + 1)::INT] AS kind FROM part")
def variant_type(spark, sf_dir):
    label = F.element_at(F.array(*map(F.lit, ("Shade: x", "Select SIZE", "Scent", "Colour", "Sizes"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", text.variant_type(F.array(F.lit(""), label), F.col("p_partkey") % 5 == 4).alias("kind"))


@R.query("SELECT event_id, try_cast(props::JSON ->> '$.k' AS DOUBLE) AS k FROM events")
def json_props(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", text.number(F.get_json_object("props", "$.k")).alias("k"))


@R.query("SELECT p_partkey, '$' || format('{:,.2f}', p_retailprice) AS price FROM part")
def price_text(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", text.price_text(F.col("p_retailprice").cast("string")).alias("price"))


@R.query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'Not available' ELSE p_size || ' g' END AS size FROM part")
def size_label(spark, sf_dir):
    gone = F.col("p_partkey") % 4 == 0
    return read(spark, sf_dir, "part").select("p_partkey", text.size_label(F.when(~gone, F.col("p_size")), F.when(gone, "").otherwise("g")).alias("size"))


@R.query("SELECT p_partkey, '$' || format('{:,.2f}', p_retailprice / p_size) || CASE WHEN p_partkey % 3 < 2 THEN '/mL' ELSE '/g' END AS unit_price FROM part")
def unit_price_text(spark, sf_dir):
    unit = F.element_at(F.array(*map(F.lit, ("mL", "fl oz", "oz"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", text.unit_price_text(F.col("p_retailprice") / F.col("p_size"), unit).alias("unit_price"))


@R.query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Unknown brand' ELSE p_brand END AS brand FROM part")
def placeholders(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", text.named(F.when(F.col("p_partkey") % 2 == 0, "").otherwise(F.col("p_brand")), "Unknown brand").alias("brand"))


@R.query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS moment, strftime(ts, '%Y%m%dT%H%M%SZ') AS run_id FROM events")
def iso_moments(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", text.iso_utc(F.col("ts")).alias("moment"), text.run_id(F.col("ts")).alias("run_id"))


@R.query("SELECT p_partkey, nullif(trim(CASE WHEN p_partkey % 5 > 0 THEN p_name || ' ' ELSE '' END || CASE WHEN p_partkey % 3 > 0 THEN p_type ELSE '' END), '') AS text FROM part")
def element_text(spark, sf_dir):
    """Text nodes of an element as one text: stripped, empty ones dropped, a blank between."""
    k = F.col("p_partkey")
    pieces = F.array(F.lit(" \n"), F.when(k % 5 > 0, F.concat(F.lit("\t"), "p_name", F.lit("  "))).otherwise(""), F.lit(""), F.when(k % 3 > 0, F.concat("p_type", F.lit("\n"))).otherwise("\u00a0"))
    return read(spark, sf_dir, "part").select(k, text.squeezed(pieces).alias("text"))
