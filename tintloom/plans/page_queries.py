"""Queries for page parsing; the driver's pages have no product data, so parts are written out as product pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tintloom.functions.urls import HostPolicy
from tintloom.operators import product_pages as P
from tintloom.plans.tables import Registry, read

R = Registry()
POLICY = HostPolicy()


def dealt_parts(spark, sf_dir):
    """Parts, dealt to all cores while rows are small: a part becomes a page that takes long to read."""
    return read(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism)


def part_pages(spark, sf_dir):
    """A product page (page_id, url, html) for every part: data in an object, a list or a graph, sale prices, swatches, ingredients."""
    k = F.col("p_partkey")
    data = F.to_json(
        F.struct(
            F.lit("Product").alias("@type"), F.concat(F.lit("prod"), k).alias("productID"), k.cast("string").alias("sku"),
            F.concat("p_name", F.lit(" - "), F.col("p_type")).alias("name"), F.struct(F.col("p_brand").alias("name")).alias("brand"), F.when(k % 2 == 0, F.col("p_type")).alias("color"),
            F.array(F.struct(F.col("p_retailprice").cast("string").alias("price"), F.lit("https://schema.example/InStock").alias("availability"))).alias("offers"),
            F.array(F.concat(F.lit("https://media.shop.example/i/"), k)).alias("image"),
            F.struct((k % 50 / 10).cast("string").alias("ratingValue"), F.concat(F.lit("1,"), F.lpad((k % 1000).cast("string"), 3, "0")).alias("reviewCount")).alias("aggregateRating"),
        )
    )
    shaped = F.when(k % 3 == 0, data).when(k % 3 == 1, F.concat(F.lit('[{"@type":"Organization"},'), data, F.lit("]"))).otherwise(F.concat(F.lit('{"@graph":[{"@type":["Product"]},'), data, F.lit("]}")))
    price = F.when(k % 4 == 0, F.concat(F.lit("Sale Price $"), F.col("p_size"), F.lit(".50 Regularly $1,200.00"))).otherwise("")
    html = F.concat(
        F.lit('<html><head><script type="application/ld+json">{broken</script><script type="application/ld+json">'), shaped, F.lit('</script></head><body><main><h1>x</h1><div class="a ProductPricing">'), price,
        F.lit('</div><p class="ProductDimension">Size: <b>'), F.col("p_size"), F.lit(' oz</b></p><div class="ProductSwatches ProductSwatches--content"><legend>Shade</legend><a href="/p/y-prod1?sku='), k + 1, F.lit('"><img src="/s/1.png" alt="b"></a></div>'),
        F.lit("<section><h3>Ingredients:</h3><p>"), F.col("p_type"), F.lit("&amp;water</p></section></main><a href='/p/z-vp"), k, F.lit("'>z</a><a href='?page=2'><b>Load</b> more</a></body></html>"),
    )
    return dealt_parts(spark, sf_dir).select(k.alias("page_id"), F.concat(F.lit("https://www.shop.example/p/a-prod"), k, F.lit("?sku="), k, F.lit("&x=1")).alias("url"), html.alias("html"))


@R.query(r"""SELECT 'https://www.shop.example/p/a-prod' || p_partkey || '?sku=' || p_partkey || '&x=1' AS url, 'prod' || p_partkey AS product_id, p_partkey::VARCHAR AS sku_id, p_brand AS brand,
  CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_name || ' - ' || p_type END AS product_name, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS variant_name, 'color' AS variant_type,
  CASE WHEN p_partkey % 4 = 0 THEN 1.0 ELSE p_retailprice END::DOUBLE AS list_price, CASE WHEN p_partkey % 4 = 0 THEN p_size + 0.5 END::DOUBLE AS sale_price, p_size || ' oz' AS size_text, 'InStock' AS availability,
  (p_partkey % 50 / 10)::DOUBLE AS rating, (1000 + p_partkey % 1000)::INT AS review_count, 'https://media.shop.example/i/' || p_partkey AS image,
  'https://media.shop.example/i/' || p_partkey || '_sw?img404=' || p_partkey || '&w=400&fmt=auto' AS swatch, p_type || '&water' AS ingredients, sha256('prod' || p_partkey || chr(0) || p_type || '&water') AS ingredient_set_id,
  2::INT AS n_urls FROM part""")
def jsonld_product(spark, sf_dir):
    """Products, variants and ingredients of all part pages."""
    found = P.product_rows(P.raw_pages(part_pages(spark, sf_dir), parts="product"), POLICY)
    return found.select(
        "url", "product.product_id", "variant.sku_id", "product.brand", "product.product_name", "variant.variant_name", "variant.variant_type", "variant.list_price", "variant.sale_price", "variant.size_text", "variant.availability",
        "product.rating", "product.review_count", F.col("variant.variant_image_url").alias("image"), F.col("variant.swatch_image_url").alias("swatch"), "ingredient.ingredients", "variant.ingredient_set_id", F.size("variant_urls").alias("n_urls"),
    )


@R.query("SELECT 'https://www.shop.example/p/a-prod' || p_partkey || '?sku=' || p_partkey || '&x=1' AS url, unnest(['prod1', 'vp' || p_partkey]) AS product_id FROM part")
def listing_links(spark, sf_dir):
    return P.listing_products(P.raw_pages(part_pages(spark, sf_dir), parts="listing"), POLICY).select("url", "product_id")


@R.query("SELECT 'https://www.shop.example/p/a-prod' || p_partkey || '?sku=' || p_partkey || '&x=1' AS url, 'https://www.shop.example/p/a-prod' || p_partkey || '?page=2' AS next FROM part")
def load_more_link(spark, sf_dir):
    return P.next_pages(P.raw_pages(part_pages(spark, sf_dir), parts="links"))


@R.query(r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages) SELECT page_id, count(*) AS n_links, count(DISTINCT href) AS n_distinct FROM l GROUP BY 1""")
def css_select(spark, sf_dir):
    """Links of the tables' own pages through the tree."""
    found = P.raw_pages(read(spark, sf_dir, "pages"), ("page_id",), "links").select("page_id", F.explode("raw.links").alias("x"))
    return found.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"), F.count_distinct("x.href").alias("n_distinct"))


BROKEN = (
    ("product data not found", "ParseError"), ("product data not found", "ParseError"), ("product id not found", "ParseError"), ("product id not found", "ParseError"), ("sku not found", "ParseError"),
    ("variant url is of another host", "ValueError"),
)


@R.query(f"""SELECT p_partkey, {[m for m, _ in BROKEN]}[(p_partkey % 7 + 1)::INT] AS error, {[t for _, t in BROKEN]}[(p_partkey % 7 + 1)::INT] AS error_type FROM part WHERE p_partkey % 7 < 6""")
def page_failures(spark, sf_dir):
    """Pages without data, with data of another type, without an id or with a blank one, without a SKU, and with an offer elsewhere; every seventh is whole."""
    k = F.col("p_partkey")
    bodies = (
        "<p>no data</p>", '{"@type":["Product"],"productID":"x"}', '{"@type":"Product","sku":"1"}', '{"@type":"Product","productID":" ","sku":"1"}', '{"@type":"Product","productID":"x","sku":""}',
        '{"@type":"Product","productID":"x","sku":"1","offers":{"url":"https://else.example/p/x"}}', '{"@type":"Product","productID":"x","sku":"1"}',
    )
    body = F.element_at(F.array(*[F.lit(b if b.startswith("<") else f'<script type="application/ld+json">{b}</script>') for b in bodies]), (k % 7 + 1).cast("int"))
    token = F.when(k % 7 == 3, F.lit("prod1?sku=1")).otherwise("thing")
    pages = dealt_parts(spark, sf_dir).select(k, F.concat(F.lit("https://www.shop.example/p/"), k, F.lit("-"), token).alias("url"), body.alias("html"))
    found = P.product_rows(P.raw_pages(pages, ("url", "p_partkey"), "product"), POLICY, ("p_partkey",))
    return found.where("error is not null").select("p_partkey", "error", "error_type")
