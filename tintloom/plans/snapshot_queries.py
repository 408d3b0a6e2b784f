"""Queries for keep-first tables, resume, manifests and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tintloom.functions import text, urls
from tintloom.operators import cleaning, snapshot
from tintloom.plans.tables import Registry, read

R = Registry()
FORMULA_SQL = "CASE WHEN length(text) > 0 THEN sha256(source || chr(0) || text) END"


def _formulas(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("source").alias("product_id"), F.col("text").alias("ingredients"), text.formula_id(F.col("source"), F.col("text")).alias("ingredient_set_id"))


@R.query(f"SELECT doc_id, {FORMULA_SQL} AS ingredient_set_id FROM documents")
def formula_id(spark, sf_dir):
    return _formulas(spark, sf_dir).select("doc_id", "ingredient_set_id")


@R.query(f"SELECT {FORMULA_SQL} AS ingredient_set_id, min(doc_id) AS doc_id FROM documents WHERE length(text) > 0 GROUP BY 1")
def formula_dedupe(spark, sf_dir):
    found = _formulas(spark, sf_dir).where("ingredient_set_id is not null").select("doc_id", "ingredient_set_id")
    return snapshot.keep_first(found, ["ingredient_set_id"], ["doc_id"])


@R.query("SELECT source AS product_id, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS brand FROM documents GROUP BY source")
def split_products(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(F.col("source").alias("product_id"), "doc_id", F.col("lang").alias("brand"))
    return snapshot.keep_first(rows, ["product_id"], ["doc_id"])


@R.query(f"SELECT doc_id AS sku_id, source AS product_id, {FORMULA_SQL} AS ingredient_set_id FROM documents")
def split_variants(spark, sf_dir):
    rows = _formulas(spark, sf_dir).select(F.col("doc_id").alias("sku_id"), "product_id", "ingredient_set_id")
    return snapshot.keep_first(rows, ["sku_id"], ["sku_id"])


@R.query(f"SELECT source AS product_id, {FORMULA_SQL} AS ingredient_set_id, length(text)::INT AS n FROM documents WHERE length(text) > 0 GROUP BY ALL")
def split_ingredients(spark, sf_dir):
    rows = _formulas(spark, sf_dir).where("ingredient_set_id is not null")
    return snapshot.keep_first(rows, ["ingredient_set_id"], ["doc_id"]).select("product_id", "ingredient_set_id", F.length("ingredients").alias("n"))


@R.query("SELECT count(*) AS rows, count(*) FILTER (length(text) > 0) AS with_ingredients, 0::BIGINT AS changed FROM documents")
def rejoin_lossless(spark, sf_dir):
    """Splitting into variants and ingredients and joining them again changes nothing."""
    rows = _formulas(spark, sf_dir)
    formulas = snapshot.keep_first(rows.where("ingredient_set_id is not null"), ["ingredient_set_id"], ["doc_id"]).select("ingredient_set_id", F.col("ingredients").alias("again"))
    joined = rows.join(formulas, "ingredient_set_id", "left")
    return joined.agg(F.count(F.lit(1)).alias("rows"), F.count("again").alias("with_ingredients"), F.count_if(~F.col("again").eqNullSafe(text.none_if_empty(F.col("ingredients")))).alias("changed"))


@R.query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def unresolved(spark, sf_dir):
    done = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return snapshot.unresolved(read(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey")


@R.query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def completed(spark, sf_dir):
    done = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return snapshot.completed_of(read(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey")


@R.query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment > 'C' AND o_orderstatus = 'O')")
def stale_keys(spark, sf_dir):
    selected = read(spark, sf_dir, "customer").where("c_mktsegment > 'C'").select(F.col("c_custkey").alias("o_custkey"), F.lit("O").alias("o_orderstatus"))
    return snapshot.stale_keys(read(spark, sf_dir, "orders"), selected, ["o_custkey", "o_orderstatus"])


@R.query("SELECT unnest(['hex_color', 'sku_id']) AS missing")
def missing_columns(spark, sf_dir):
    found = snapshot.missing_columns(read(spark, sf_dir, "part"), ["p_partkey", "sku_id", "hex_color", "p_name"])
    return spark.createDataFrame([(c,) for c in found], "missing string")


def _run(spark, sf_dir):
    orders, docs = read(spark, sf_dir, "orders"), read(spark, sf_dir, "documents")
    inventory = orders.select(F.col("o_orderkey").alias("product_id"))
    done = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("product_id"))
    variants = docs.select(F.when(F.col("lang") == "en", text.formula_id(F.col("source"), F.col("text"))).alias("ingredient_set_id"))
    return inventory, done, variants, variants.where("ingredient_set_id is not null").distinct(), orders.where("o_orderstatus = 'F'")


@R.query(f"""WITH i AS (SELECT count(DISTINCT o_orderkey) AS n FROM orders), c AS (SELECT count(DISTINCT o_orderkey) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
  v AS (SELECT count(*) AS n, count(*) FILTER (lang IS DISTINCT FROM 'en' OR coalesce(length(text), 0) = 0) AS without, count(DISTINCT CASE WHEN lang = 'en' THEN {FORMULA_SQL} END) AS sets FROM documents),
  f AS (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F')
  SELECT i.n AS inventory, c.n AS completed, v.n AS variants, v.without AS variants_without_ingredients, v.sets AS ingredient_sets, f.n AS failures, i.n - c.n AS unresolved,
         CASE WHEN i.n = c.n THEN 'complete' ELSE 'partial' END AS status FROM i, c, v, f""")
def run_manifest(spark, sf_dir):
    return snapshot.run_counts(*_run(spark, sf_dir))


@R.query("SELECT source, count(*) FILTER (lang IS DISTINCT FROM 'en' OR coalesce(length(text), 0) = 0) AS without FROM documents GROUP BY source")
def without_ingredients(spark, sf_dir):
    formula = F.when(F.col("lang") == "en", text.formula_id(F.col("source"), F.col("text")))
    return read(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(F.coalesce(formula, F.lit("")) == "").alias("without"))


@R.query("SELECT c_custkey, CASE WHEN count(o_orderkey) FILTER (o_orderstatus = 'F') = count(o_orderkey) THEN 'complete' ELSE 'partial' END AS status FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def run_status(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    joined = read(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left")
    return joined.select("c_custkey", snapshot.run_status(F.coalesce("done", F.lit(0)), F.coalesce("n", F.lit(0))).alias("status"))


@R.query("SELECT o_orderpriority, count(*) AS attempted, count(*) FILTER (o_orderstatus <> 'F') AS succeeded, count(*) FILTER (o_orderstatus = 'F') AS failed FROM orders GROUP BY 1")
def outcome_counts(spark, sf_dir):
    failed = F.col("o_orderstatus") == "F"
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("attempted"), F.count_if(~failed).alias("succeeded"), F.count_if(failed).alias("failed"))


@R.query("""SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS occurred_at, 'variant' AS stage, user_id::VARCHAR AS product_id, 'e' || event_id AS url, event_type AS error_type, left(repeat(props, 100), 1000) AS message
  FROM events WHERE value > 50""")
def failure_log(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    outcomes = events.select("ts", F.col("user_id").cast("string").alias("product_id"), F.concat(F.lit("e"), F.col("event_id")).alias("url"), F.when(F.col("value") > 50, F.col("event_type")).alias("error_type"), F.repeat("props", 100).alias("message"))
    return snapshot.failures_of(outcomes, "variant", text.iso_utc(F.col("ts")))


@R.query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def inventory_limit(spark, sf_dir):
    return snapshot.first_n(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), 100, ["o_orderdate", "o_orderkey"])


@R.query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0")
def resume_union(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    new = orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return snapshot.resume_union(orders.where("o_orderkey % 3 = 0"), new, ["o_orderkey"])


@R.query("""WITH t AS (SELECT trim(user_id::VARCHAR) AS sku_id, event_type AS url, min(event_id) AS first_event FROM events GROUP BY ALL) SELECT sku_id, arg_min(url, first_event) AS url, count(*) AS n_urls FROM t GROUP BY 1""")
def input_contract(spark, sf_dir):
    rows = snapshot.require_columns(read(spark, sf_dir, "events"), ["user_id", "event_type"], "events").select(F.trim(F.col("user_id").cast("string")).alias("sku_id"), F.col("event_type").alias("url"), "event_id")
    return rows.groupBy("sku_id").agg(F.min_by("url", "event_id").alias("url"), F.count_distinct("url").alias("n_urls"))


@R.query("SELECT user_id, count(DISTINCT event_type) AS n_values FROM events GROUP BY 1 HAVING n_values > 1")
def key_conflicts(spark, sf_dir):
    return snapshot.key_conflicts(read(spark, sf_dir, "events"), "user_id", "event_type")


@R.query(r"SELECT page_id, starts_with(url, 'https://') AND lower(regexp_extract(url, '://(?:[^/?#@]*@)?([^/?#:]*)', 1)) = 'media.shop.example' AS valid FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_replace(url, '://[^/?#]*', '://media.shop.example') ELSE url END AS url FROM pages)")
def host_validation(spark, sf_dir):
    moved = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", "://[^/?#]*", "://media.shop.example")).otherwise(F.col("url"))
    return read(spark, sf_dir, "pages").select("page_id", urls.is_swatch_url(moved, urls.HostPolicy()).alias("valid"))


@R.query("""WITH v AS (SELECT p_partkey, p_brand, p_name, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice - 1 ELSE p_retailprice END AS effective_price,
    CASE p_partkey % 4 WHEN 0 THEN p_size * 2.0::DOUBLE WHEN 3 THEN NULL ELSE p_size::DOUBLE END AS size_value, ['oz', 'fl oz', 'g', NULL][(p_partkey % 4 + 1)::INT] AS size_unit FROM part)
  SELECT 'sku' || p_partkey AS sku_id, p_brand AS brand, p_name AS product_name, effective_price, size_value, size_unit,
    effective_price / CASE size_unit WHEN 'oz' THEN size_value * 28.3495 WHEN 'fl oz' THEN size_value * 29.5735 ELSE size_value END AS price_per_g_ml,
    CASE WHEN p_partkey % 3 = 0 THEN 'with_swatch' ELSE 'no_swatch' END AS category FROM v""")
def clean_variants(spark, sf_dir):
    """Parts as variants with sizes such as `5 (x2) oz`, and one in four with a leaked colour instead of a size."""
    k, parts = F.col("p_partkey"), read(spark, sf_dir, "part")
    shown = F.when(k % 4 == 0, F.concat("p_size", F.lit(" (x2) oz"))).when(k % 4 == 1, F.concat("p_size", F.lit(" FL OZ"))).when(k % 4 == 2, F.concat("p_size", F.lit("g"))).otherwise("Color: Light")
    product = F.concat(F.lit("prod"), k).alias("product_id")
    variants = parts.select(
        product, F.concat(F.lit("sku"), k).alias("sku_id"), F.col("p_type").alias("variant_name"), F.lit("").alias("variant_url"), F.when(k % 3 == 0, "https://media.shop.example/i/x").alias("swatch_image_url"), F.lit("").alias("variant_image_url"),
        F.col("p_retailprice").alias("list_price"), F.when(k % 2 == 0, F.col("p_retailprice") - 1).alias("sale_price"), shown.alias("size_text"),
    )
    products = parts.select(product, F.col("p_brand").alias("brand"), F.col("p_name").alias("product_name"))
    return cleaning.cleaned(variants, products).select("sku_id", "brand", "product_name", "effective_price", "size_value", "size_unit", "price_per_g_ml", "category")
