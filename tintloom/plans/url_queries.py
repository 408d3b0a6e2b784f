"""Queries for URL rules, links, first-wins deduplication and pagination."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tintloom.functions import urls
from tintloom.operators import snapshot
from tintloom.plans.tables import Registry, read

R = Registry()
POLICY = urls.HostPolicy(hosts=(".example.com", ".example.net"), canonical="www.shop.example", parameter="page")
HOST_SQL = r"nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '')"
PATH_SQL = r"regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
PARAM_SQL = r"nullif(regexp_extract(url, '^[^?#]*\?(?:[^#]*?&)??{0}=([^&#]+)', 1), '')"
LINKS_SQL = r"""links AS (
  SELECT page_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS href
  FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages))"""


def links(spark, sf_dir):
    """(page_id, pos, href) of every link of every page."""
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("pos", "href"))


@R.query(f"""SELECT page_id, CASE WHEN {HOST_SQL} LIKE '%.example.com' OR {HOST_SQL} LIKE '%.example.net' THEN 'https://www.shop.example' || {PATH_SQL}
  || CASE WHEN {PARAM_SQL.format("page")} IS NULL THEN '' ELSE '?page=' || {PARAM_SQL.format("page")} END END AS url FROM pages""")
def url_normalize(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.normalized(F.col("url"), F.lit("https://www.shop.example/"), POLICY).alias("url"))


@R.query(r"""SELECT p_partkey, nullif(regexp_extract('/p/' || lower(p_name) || '-' || ['PIMPROD', 'xlsImpprod', 'vp', 'none'][(p_partkey % 4 + 1)::INT] || p_partkey, '(?i)(pimprod\d+|xlsimpprod\d+|prod\d+|mkt\d+|vp\d+)', 1), '') AS token FROM part""")
def url_token(spark, sf_dir):
    kind = F.element_at(F.array(*map(F.lit, ("PIMPROD", "xlsImpprod", "vp", "none"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    url = F.concat(F.lit("https://www.shop.example/p/"), F.lower("p_name"), F.lit("-"), kind, F.col("p_partkey"), F.lit("?sku=prod1"))
    return read(spark, sf_dir, "part").select("p_partkey", urls.product_token(url).alias("token"))


@R.query(f"SELECT page_id, {PARAM_SQL.format('utm_source')} AS source, {PARAM_SQL.format('page')} AS page, {PARAM_SQL.format('ref')} AS ref FROM pages")
def url_param(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", *[urls.parameter(url, p).alias(a) for p, a in (("utm_source", "source"), ("page", "page"), ("ref", "ref"))])


@R.query("SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages")
def url_strip(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.without_query(F.col("url")).alias("url"))


@R.query(f"SELECT page_id, {HOST_SQL} AS host FROM pages WHERE {HOST_SQL} LIKE '%.example.com' OR {HOST_SQL} LIKE '%.example.net'")
def url_host_filter(spark, sf_dir):
    found = read(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"))
    return found.where(urls.is_allowed(F.col("host"), POLICY))


@R.query("SELECT page_id, split_part(url, '/', -1) AS segment FROM pages")
def url_last_segment(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.availability(F.col("url")).alias("segment"))


@R.query(f"SELECT page_id, CASE WHEN starts_with({PATH_SQL}, '/en/') THEN 'product' ELSE 'listing' END AS kind FROM pages")
def source_type(spark, sf_dir):
    moved = F.regexp_replace("url", "://([^/?#]*)/en/", "://$1/p/")
    return read(spark, sf_dir, "pages").select("page_id", urls.source_type(moved).alias("kind"))


@R.query(rf"""SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_extract(regexp_replace({PATH_SQL}, '/+$', ''), '([^/]*)$', 1)), '[^a-z0-9_-]+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), ''), 'collection') AS name FROM pages""")
def slug_name(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.collection_name(F.col("url")).alias("name"))


@R.query(r"""SELECT page_id, 'https://' || regexp_extract(url, '://([^/?#]*)', 1) || '/x/' || page_id || '?sku=' || page_id AS with_sku,
  CASE WHEN page_id % 3 = 0 THEN 'https://media.shop.example/i/' || page_id || '_sw?img404=' || page_id || '&w=400&fmt=auto' END AS swatch FROM pages""")
def url_variant(spark, sf_dir):
    pages, sku = read(spark, sf_dir, "pages"), F.col("page_id").cast("string")
    base = F.concat(F.lit("https://"), F.regexp_extract("url", "://([^/?#]*)", 1), F.lit("/x/"), sku, F.when(F.col("page_id") % 2 == 0, "").otherwise(F.concat(F.lit("?sku="), sku)))
    kind = F.when(F.col("page_id") % 3 == 0, "color").otherwise("default")
    policy = urls.HostPolicy()
    return pages.select("page_id", urls.with_variant(base, sku, policy).alias("with_sku"), urls.swatch_url(F.lit(None).cast("string"), kind, sku, policy).alias("swatch"))


@R.query(f"WITH {LINKS_SQL} SELECT page_id, pos::INT AS pos, href FROM links")
def html_links(spark, sf_dir):
    return links(spark, sf_dir)


@R.query(f"WITH {LINKS_SQL} SELECT lower(href) AS k, arg_min(page_id, (page_id, pos)) AS page_id, arg_min(pos, (page_id, pos))::INT AS pos, arg_min(href, (page_id, pos)) AS href FROM links GROUP BY ALL")
def first_wins_links(spark, sf_dir):
    return snapshot.keep_first(links(spark, sf_dir).withColumn("k", F.lower("href")), ["k"], ["page_id", "pos"])


@R.query(f"""WITH {LINKS_SQL}, f AS (SELECT lower(href) AS k, arg_min(page_id, (page_id, pos)) AS page_id, arg_min(pos, (page_id, pos)) AS pos, arg_min(href, (page_id, pos)) AS href FROM links GROUP BY ALL)
  SELECT page_id, pos::INT AS pos, href, row_number() OVER (ORDER BY page_id, pos) AS listing_position FROM f""")
def link_inventory_positions(spark, sf_dir):
    firsts = snapshot.keep_first(links(spark, sf_dir).withColumn("k", F.lower("href")), ["k"], ["page_id", "pos"]).drop("k")
    return snapshot.positions(firsts, ["page_id", "pos"], "listing_position")


@R.query(r"""SELECT page_id, regexp_extract(html, '<a href="([^"]*)">[^<]*[aA][nN][dD]', 1) AS href FROM pages WHERE regexp_extract(html, '<a href="([^"]*)">[^<]*[aA][nN][dD]', 1) <> ''""")
def next_link(spark, sf_dir):
    """The first link of a page whose text has a word, as the link to the next page has."""
    found = read(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", '<a href="([^"]*)">[^<]*[aA][nN][dD]', 1).alias("href"))
    return found.where("href <> ''")


RELATIVE = ("../x/{};v=1?page=2", "./{}", "/a/../../{}/..", "{}/../../y;p/z", "?page={}", "//h.example.com/./{}", "/a//{}/.")


@R.query(r"""SELECT page_id, 'https://www.shop.example' || [
    '/x/' || page_id || '?page=2', '/s/' || page_id, '/', '/y;p/z', '/s/t?page=' || page_id, '/./' || page_id, '/a//' || page_id || '/'][(page_id % 7 + 1)::INT] AS url FROM pages""")
def url_resolve(spark, sf_dir):
    """Relative addresses of every form against a page of the shop."""
    shaped = F.element_at(F.array(*[F.replace(F.lit(r), F.lit("{}"), F.col("page_id").cast("string")) for r in RELATIVE]), (F.col("page_id") % len(RELATIVE) + 1).cast("int"))
    return read(spark, sf_dir, "pages").select("page_id", urls.normalized(shaped, F.lit("https://h.example.com/s/t?q=1"), POLICY).alias("url"))


@R.query(r"""SELECT page_id, ['prod1', 'face-lips_2', 'caf-x', 'collection', 'b-c'][(page_id % 5 + 1)::INT] AS name FROM pages""")
def collection_names(spark, sf_dir):
    """Names that a one-off run gets from its address."""
    ends = ("/p/x-PROD1", "/shop/face-lips_2/", "/shop/Caf%x", "/--/", "/_B C-/")
    url = F.concat(F.lit("https://www.shop.example"), F.element_at(F.array(*map(F.lit, ends)), (F.col("page_id") % 5 + 1).cast("int")))
    return read(spark, sf_dir, "pages").select("page_id", urls.collection_name(url).alias("name"))


@R.query("""WITH RECURSIVE t AS (SELECT 'c' || conv_id || '-' || turn AS url, 'c' || conv_id || '-' || (turn + 1) AS next FROM conversations GROUP BY ALL),
  c AS (SELECT url AS start, url, next, 1 AS page_no FROM t WHERE url LIKE '%-0' UNION ALL SELECT start, t.url, t.next, page_no + 1 FROM c JOIN t ON t.url = c.next WHERE page_no < 200)
  SELECT start, url, page_no::INT AS page_no FROM c""")
def pagination_closure(spark, sf_dir):
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), turn)
    pages = read(spark, sf_dir, "conversations").select(name(F.col("turn")).alias("url"), name(F.col("turn") + 1).alias("next")).distinct()
    starts = pages.where(F.col("url").endswith("-0")).select(F.col("url").alias("start"))
    return snapshot.pagination_from(pages, starts, 200)


@R.query("""WITH RECURSIVE n AS (SELECT (SELECT count(*) FROM part) AS parts), c AS (SELECT 0 AS k UNION ALL SELECT k + 1 FROM c, n WHERE k < 120 AND (k * 7 < parts))
  SELECT 'l' || k AS url, (k + 1)::INT AS page_no FROM c""")
def pagination_stop(spark, sf_dir):
    """A chain of listing pages of seven parts each ends with the first page that brings no new product, or after 121."""
    parts = read(spark, sf_dir, "part").select((F.row_number().over(Window.orderBy("p_partkey")) - 1).alias("i"), F.col("p_partkey").cast("string").alias("id"))
    listed = parts.groupBy(F.floor(F.col("i") / 7).alias("k")).agg(F.collect_list("id").alias("product_ids"))
    old = F.array(F.lit("1"), F.lit("2"))
    pages = spark.range(150).select(F.col("id").alias("k")).join(listed, "k", "left")
    pages = pages.select(F.concat(F.lit("l"), "k").alias("url"), F.concat(F.lit("l"), F.col("k") + 1).alias("next"), F.coalesce("product_ids", old).alias("product_ids"))
    return snapshot.pagination(pages, "l0", 121)
