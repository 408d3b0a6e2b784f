"""Queries for sources, sinks, contracts and runs: each writes and reads back, or runs the operator on broken input too."""

from __future__ import annotations

import re
import struct
import zlib

from pyspark.sql import functions as F

from tintloom import config
from tintloom.functions import text
from tintloom.functions.urls import HostPolicy
from tintloom.operators import product_pages as P
from tintloom.operators import runs, snapshot
from tintloom.plans import colour_map
from tintloom.plans.catalogue_run import run_catalogue
from tintloom.plans.color_queries import color_map, lab_sql
from tintloom.plans.page_queries import dealt_parts, part_pages
from tintloom.plans.tables import Registry, read
from tintloom.sources import files, http, images, sinks

R = Registry()
POLICY = HostPolicy()
MOMENT = "2026-01-01T00:00:00Z"


@R.query("""SELECT s_suppkey::VARCHAR AS id, s_name || chr(10) || '"é", ' || s_nationkey AS name, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS note FROM supplier""")
def csv_round_trip(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.concat("s_name", F.lit('\n"é", '), "s_nationkey").alias("name"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).otherwise("").alias("note"), F.lit(1).alias("more"))
    path = files.scratch(spark) / "suppliers.csv"
    sinks.write_csv_file(rows, path, ("note", "id", "name"))
    return files.csv_table(spark, str(path), ("id", "name")).select("id", "name", "note")


@R.query("SELECT n_nationkey::INT AS n_nationkey, 'is missing: ' || n_name AS found FROM nation")
def csv_missing(spark, sf_dir):
    """A CSV file that isn't there is an empty table, or an error where it must be."""
    path = str(files.scratch(spark) / "none.csv")
    assert files.csv_rows(spark, path, ("id", "name")).columns == ["id", "name"]
    nothing = files.csv_rows(spark, path, ("id",)).select(F.col("id").cast("int").alias("n_nationkey"))
    try:
        files.csv_table(spark, path, ())
        found = "is there"
    except FileNotFoundError:
        found = "is missing"
    nations = read(spark, sf_dir, "nation")
    return nations.join(nothing, "n_nationkey", "left_anti").select("n_nationkey", F.concat(F.lit(f"{found}: "), "n_name").alias("found"))


@R.query("SELECT n_name || 'é' AS name, n_nationkey::INT AS k FROM nation")
def json_round_trip(spark, sf_dir):
    path = files.scratch(spark) / "nations.json"
    sinks.write_json_file({r["n_name"] + "é": r["n_nationkey"] for r in read(spark, sf_dir, "nation").collect()}, path)
    return spark.createDataFrame(list(files.json_document(spark, str(path)).items()), "name string, k int")


@R.query("""SELECT 'n' || n_nationkey AS name, 'https://www.shop.example/' || CASE WHEN n_nationkey % 2 = 0 THEN 'p/x-prod' ELSE 'shop/x' END || n_nationkey AS source_url,
  CASE WHEN n_nationkey % 2 = 0 THEN 'product' ELSE 'listing' END AS kind, 7::INT AS max_pages, 25::INT AS checkpoint_interval, (SELECT count(*) FROM nation)::INT AS n FROM nation""")
def collections_and_settings(spark, sf_dir):
    folder, nations = files.scratch(spark), [r["n_nationkey"] for r in read(spark, sf_dir, "nation").collect()]
    (folder / "s.toml").write_text("[scraper]\nmax_pages = 7\n")
    (folder / "c.toml").write_text("\n".join(f'[collections.n{k}]\nsource_url = "https://www.shop.example/{"p/x-prod" if k % 2 == 0 else "shop/x"}{k}"' for k in nations))
    names = config.collection_names(folder / "c.toml")
    found = [config.load_collection(folder / "s.toml", folder / "c.toml", n, POLICY.hosts) for n in names]
    rows = [(c.name, c.source_url, c.to_dict()["resolved_source_type"], c.settings.max_pages, c.settings.checkpoint_interval, len(names)) for c in found]
    return spark.createDataFrame(rows, "name string, source_url string, kind string, max_pages int, checkpoint_interval int, n int")


BAD_COLLECTIONS = (
    {"name": "Upper"}, {"name": ""}, {"source_url": "http://shop.example/shop/x"}, {"source_url": "https://else.example/shop/x"}, {"source_url": "https://shop.example/else/x"}, {"source_type": "none"},
    {"source_type": "product"}, {"source_type": "listing", "source_url": "https://shop.example/p/x"}, {},
)


@R.query("SELECT range::INT AS i, range < 8 AS refused FROM range(9)")
def collections_refused(spark, sf_dir):
    def refused(change) -> bool:
        try:
            config.Collection(**{"name": "a", "source_url": "https://shop.example/shop/x", "hosts": POLICY.hosts, **change})
            return False
        except ValueError:
            return True

    return spark.createDataFrame([(i, refused(c)) for i, c in enumerate(BAD_COLLECTIONS)], "i int, refused boolean")


@R.query("""SELECT 'prod' || s_suppkey AS product_id, 'https://www.shop.example/p/a-prod' || s_suppkey AS product_url, NULL::VARCHAR AS listing_page, row_number() OVER (ORDER BY s_suppkey) AS listing_position FROM supplier""")
def explicit_products(spark, sf_dir):
    """Addresses given by hand, every second one twice with another case and variant."""
    keys = sorted(r["s_suppkey"] for r in read(spark, sf_dir, "supplier").select("s_suppkey").collect())
    addresses = [a for k in keys for a in (f"https://shop.example/p/a-prod{k}?sku={k}", *([f"/p/b-PROD{k}?x=1"] if k % 2 else []))]
    return files.product_list(spark, addresses, POLICY)


@R.query("SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE p_name || ' é' END AS html, ['utf-8', 'iso-8859-1', NULL, 'ascii'][(p_partkey % 4 + 1)::INT] AS charset FROM part")
def decoding_ladder(spark, sf_dir):
    """UTF-8 in composed and other form, a declared charset, and what can't be decoded."""
    k, name = F.col("p_partkey"), F.concat("p_name", F.lit(" é"))
    content = F.when(k % 4 == 0, F.encode(name, "UTF-8")).when(k % 4 == 2, F.encode(F.concat("p_name", F.lit(" é")), "UTF-8")).otherwise(F.encode(name, "ISO-8859-1"))
    kind = F.when(k % 4 == 0, 'text/html; charset="UTF-8"').when(k % 4 == 1, "text/html;Charset = ISO-8859-1").when(k % 4 == 2, "text/html").otherwise("text/html; charset=ascii")
    charset = files.declared_charset(kind)
    return read(spark, sf_dir, "part").select("p_partkey", files.decoded_html(content, charset).alias("html"), charset.alias("charset"))


@R.query("""SELECT 'sku' || c_custkey AS sku_id, 'https://media.shop.example/i/' || c_custkey AS swatch_image_url FROM customer""")
def swatch_contract(spark, sf_dir):
    """The rows that a good input gives, each customer twice with blanks around."""
    base = read(spark, sf_dir, "customer").select(F.concat(F.lit("sku"), "c_custkey").alias("sku_id"), F.concat(F.lit("https://media.shop.example/i/"), "c_custkey").alias("swatch_image_url"))
    again = base.select(F.concat(F.lit(" "), "sku_id").alias("sku_id"), F.concat("swatch_image_url", F.lit("  ")).alias("swatch_image_url"))
    return files.swatch_input(base.union(again), POLICY)


@R.query("""SELECT unnest(['empty sku', 'empty url', 'host', 'missing column', 'scheme', 'two urls']) AS fault, unnest([
  'rows without SKU or URL, the first is data row 2', 'rows without SKU or URL, the first is data row 2', 'swatch URLs aren''t https addresses of media.shop.example', 'swatch input lacks columns: swatch_image_url',
  'swatch URLs aren''t https addresses of media.shop.example', 'SKU 1 has N URLs']) AS message""")
def swatch_contract_faults(spark, sf_dir):
    keys, good = read(spark, sf_dir, "region").coalesce(1).select(F.col("r_regionkey").cast("string").alias("k")), F.lit("https://media.shop.example/i/x")
    faults = {
        "empty sku": (F.lit(" "), good), "empty url": (F.col("k"), F.lit("")), "host": (F.col("k"), F.lit("https://else.example/i/x")), "scheme": (F.col("k"), F.lit("http://media.shop.example/i/x")),
        "two urls": (F.lit("1"), F.concat(good, "k")), "missing column": (F.col("k"), None),
    }

    def message(sku, url) -> str:
        try:
            files.swatch_input(keys.select(sku.alias("sku_id"), *([] if url is None else [url.alias("swatch_image_url")])), POLICY).count()
            return "none"
        except snapshot.ContractError as error:
            return re.sub(r"has \d+ URLs", "has N URLs", re.sub(r"^\d+ ", "", str(error)))

    return spark.createDataFrame([(name, message(*columns)) for name, columns in sorted(faults.items())], "fault string, message string")


def _png(side: int, rgb: tuple[int, int, int], border: tuple[int, ...]) -> bytes:
    """An RGBA PNG with a one-pixel border of another colour."""
    edge = lambda i: i in (0, side - 1)
    raw = b"".join(b"\0" + b"".join(bytes(border if edge(x) or edge(y) else (*rgb, 255)) for x in range(side)) for y in range(side))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", side, side, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def nation_images(spark, sf_dir):
    """(swatches, images): a swatch of every nation, its image file named by its key; every seventh file can't be read, every eleventh isn't there."""
    folder, nations = files.scratch(spark), read(spark, sf_dir, "nation")
    for k in (r["n_nationkey"] for r in nations.collect()):
        if k % 11 != 10:
            (folder / f"{k}.png").write_bytes(b"no image" if k % 7 == 6 else _png(20, (k * 10 % 256, k * 7 % 256, 200), (255, 255, 255, 0)))
    found = images.image_files(spark, str(folder)).withColumn("swatch_image_url", F.concat(F.lit("https://media.shop.example/i/"), F.regexp_extract("path", r"([^/]+)\.png$", 1)))
    k = F.col("n_nationkey").cast("string")
    return nations.select(F.col("n_name").alias("product_id"), k.alias("sku_id"), F.concat(F.lit("https://media.shop.example/i/"), k).alias("swatch_image_url")), found


NATION_LAB = f"WITH rgb AS (SELECT n_nationkey AS k, n_name, (n_nationkey * 10 % 256)::INT AS r, (n_nationkey * 7 % 256)::INT AS g, 200::INT AS b FROM nation WHERE n_nationkey % 7 <> 6 AND n_nationkey % 11 <> 10), {lab_sql('rgb')}"


@R.query(f"""{NATION_LAB} SELECT n_name AS product_id, k::VARCHAR AS sku_id, 20::INT AS image_width, 20::INT AS image_height, 16::BIGINT AS sample_pixel_count, r AS rgb_r, g AS rgb_g, b AS rgb_b,
  format('#{{:02x}}{{:02x}}{{:02x}}', r, g, b) AS hex_color, lab_l + 0.0 AS lab_l, lab_a + 0.0 AS lab_a, lab_b + 0.0 AS lab_b, 0.0::DOUBLE AS rgb_spread, 'center_crop_median_v1' AS extraction_method FROM lab""")
def swatch_images(spark, sf_dir):
    """Colours of image files through the whole colour run."""
    good, _ = runs.color_run(*nation_images(spark, sf_dir))
    return good.drop("swatch_image_url", "image_sha256").withColumns({c: F.col(c) + 0.0 for c in ("lab_l", "lab_a", "lab_b")}).withColumn("sample_pixel_count", F.col("sample_pixel_count").cast("long"))


@R.query("""SELECT n_nationkey::VARCHAR AS sku_id, CASE WHEN n_nationkey % 11 = 10 THEN 'LookupError' ELSE 'UnidentifiedImageError' END AS error_type,
  CASE WHEN n_nationkey % 11 = 10 THEN 'no image' ELSE 'not a readable image' END AS message FROM nation WHERE n_nationkey % 7 = 6 OR n_nationkey % 11 = 10""")
def swatch_image_failures(spark, sf_dir):
    _, bad = runs.color_run(*nation_images(spark, sf_dir))
    return bad.select("sku_id", "error_type", "message")


@R.query(f"""{NATION_LAB} SELECT k::VARCHAR AS sku_id, CASE WHEN k % 3 = 0 THEN 'saved' ELSE format('#{{:02x}}{{:02x}}{{:02x}}', r, g, b) END AS hex_color FROM lab
  UNION ALL SELECT n_nationkey::VARCHAR, 'saved' FROM nation WHERE n_nationkey % 3 = 0 AND (n_nationkey % 7 = 6 OR n_nationkey % 11 = 10)""")
def color_resume(spark, sf_dir):
    """A colour run that goes on: saved colours stay as they are and aren't measured."""
    swatches, found = nation_images(spark, sf_dir)
    first, _ = runs.color_run(swatches, found)
    saved = swatches.where("cast(sku_id as int) % 3 = 0").select("product_id", "sku_id", "swatch_image_url", *[(F.lit("saved") if f.name == "hex_color" else F.lit(None).cast(f.dataType)).alias(f.name) for f in first.schema.fields[3:]])
    good, _ = runs.color_run(swatches, found, saved)
    return good.select("sku_id", "hex_color")


@R.query("""SELECT CASE WHEN count(*) FILTER (o_orderstatus <> 'F') = count(*) THEN 'complete' ELSE 'partial' END AS status, count(*) AS input_row_count, count(*) FILTER (o_orderstatus <> 'F') AS completed_row_count,
  count(*) FILTER (o_orderstatus = 'F') AS unresolved_row_count, count(*) FILTER (o_orderstatus = 'F' OR o_orderstatus = 'O') AS attempted_this_run, count(*) FILTER (o_orderstatus = 'O') AS succeeded_this_run,
  count(*) FILTER (o_orderstatus = 'F') AS failed_this_run, 2 * count(*) FILTER (o_orderstatus = 'F') AS failure_attempt_count FROM orders""")
def color_manifest(spark, sf_dir):
    """Counters of a colour run in which open orders are the new colours and finished ones fail for the second time."""
    orders = read(spark, sf_dir, "orders")
    lost = orders.where("o_orderstatus = 'F'")
    return runs.attempt_counts(orders, orders.where("o_orderstatus not in ('F', 'O')"), orders.where("o_orderstatus <> 'F'"), lost, lost.union(lost))


@R.query("""SELECT sha256(string_agg(n_name, chr(10) ORDER BY n_nationkey)) AS digest FROM nation""")
def file_digest(spark, sf_dir):
    path = files.scratch(spark) / "names.txt"
    sinks.write_text_file("\n".join(r["n_name"] for r in read(spark, sf_dir, "nation").orderBy("n_nationkey").collect()), path)
    return spark.createDataFrame([(images.file_sha256(spark, str(path)),)], "digest string")


def keeper(spark):
    """Stores frames that several others are made of as tables."""
    folder = files.scratch(spark)

    def keep(frame, name):
        frame.write.parquet(f"file://{folder}/{name}")
        return spark.read.parquet(f"file://{folder}/{name}")

    return keep


def part_run(spark, sf_dir, repaired: bool = False):
    """(inventory, pages) of parts: even keys first; pages of keys that end in 0 are missing and of those in 5 broken, unless repaired."""
    k, n = F.col("page_id"), read(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0]
    pages = part_pages(spark, sf_dir)
    inventory = pages.select(F.concat(F.lit("prod"), k).alias("product_id"), F.col("url").alias("product_url"), F.lit(None).cast("string").alias("listing_page"), F.when(k % 2 == 0, k).otherwise(k + n).alias("listing_position"))
    if not repaired:
        pages = pages.where(k % 10 != 0).withColumn("html", F.when(k % 10 == 5, "<p>broken</p>").otherwise(F.col("html")))
    return inventory, pages.select("url", "html")


FAILED_SQL = """SELECT 'product' AS stage, p_partkey, 'https://www.shop.example/p/a-prod' || p_partkey || '?sku=' || p_partkey || '&x=1' AS url, CASE WHEN p_partkey % 10 = 0 THEN 'LookupError' ELSE 'ParseError' END AS error_type,
    CASE WHEN p_partkey % 10 = 0 THEN 'page not found' ELSE 'product data not found' END AS message FROM part WHERE p_partkey % 5 = 0
  UNION ALL SELECT 'variant', p_partkey, 'https://www.shop.example/p/y-prod1?sku=' || (p_partkey + 1), 'LookupError', 'page not found' FROM part WHERE p_partkey % 10 IN (2, 4, 6, 8, 9)"""


@R.query("SELECT 'prod' || p_partkey AS product_id FROM part WHERE p_partkey % 10 IN (1, 3, 7)")
def completed_products(spark, sf_dir):
    """Products whose page and variants could all be read: those whose variant's SKU comes from a page before count."""
    inventory, pages = part_run(spark, sf_dir)
    return runs.catalogue_tables(inventory, pages, POLICY, F.lit(MOMENT), store=keeper(spark))["completed"]


@R.query(f"SELECT '{MOMENT}' AS occurred_at, stage, 'prod' || p_partkey AS product_id, url, error_type, message FROM ({FAILED_SQL})")
def run_failures(spark, sf_dir):
    inventory, pages = part_run(spark, sf_dir)
    return runs.catalogue_tables(inventory, pages, POLICY, F.lit(MOMENT), store=keeper(spark))["failures"]


@R.query("SELECT 'prod' || p_partkey AS product_id, p_partkey::VARCHAR AS sku_id FROM part WHERE p_partkey % 5 > 0")
def run_variants(spark, sf_dir):
    inventory, pages = part_run(spark, sf_dir)
    return runs.catalogue_tables(inventory, pages, POLICY, F.lit(MOMENT), store=keeper(spark))["variants"].select("product_id", "sku_id")


def _resumed(spark, sf_dir):
    first, keep = runs.catalogue_tables(*part_run(spark, sf_dir), POLICY, F.lit(MOMENT), store=keeper(spark)), keeper(spark)
    saved = {name: keep(frame, name) for name, frame in first.items()}
    return runs.catalogue_tables(*part_run(spark, sf_dir, repaired=True), POLICY, F.lit("2026-01-02T00:00:00Z"), saved, keeper(spark))


#: The last part's variant is no part's page, so it stays open.
OPEN_SQL = "(p_partkey % 10 = 4 OR p_partkey % 10 = 9 AND p_partkey = (SELECT max(p_partkey) FROM part))"


@R.query(f"SELECT 'prod' || p_partkey AS product_id FROM part WHERE NOT {OPEN_SQL}")
def resumed_run(spark, sf_dir):
    """A run that goes on over repaired pages: what was completed stays so, known SKUs aren't read again."""
    return _resumed(spark, sf_dir)["completed"]


@R.query(f"""SELECT stage, product_id, occurred_at, error_type FROM (SELECT stage, 'prod' || p_partkey AS product_id, '{MOMENT}' AS occurred_at, error_type FROM ({FAILED_SQL})
  UNION ALL SELECT 'variant', 'prod' || p_partkey, '2026-01-02T00:00:00Z', 'LookupError' FROM part WHERE {OPEN_SQL})""")
def resumed_failures(spark, sf_dir):
    """The log keeps every attempt of both runs."""
    return _resumed(spark, sf_dir)["failures"].select("stage", "product_id", "occurred_at", "error_type")


@R.query("""SELECT 'partial' AS state, 3::INT AS n_parts, count(*) FILTER (n_nationkey % 4 > 0)::INT AS product_count, count(*)::INT AS inventory_product_count, count(*) FILTER (n_nationkey % 4 = 0)::INT AS unresolved_product_count,
  string_agg('prod' || n_nationkey, ',' ORDER BY 'prod' || n_nationkey) FILTER (n_nationkey % 4 > 0) AS completed_product_ids FROM nation""")
def run_state(spark, sf_dir):
    """A run over a page of each nation, committed in three batches, as its checkpoint tells."""
    k = F.col("n_nationkey")
    name = F.concat(F.lit("https://www.shop.example/p/a-prod"), k, F.lit("?sku="), k)
    nations = read(spark, sf_dir, "nation")
    data = F.concat(F.lit('<script type="application/ld+json">{"@type":"Product","productID":"prod'), k, F.lit('","sku":"'), k, F.lit('"}</script>'))
    pages = nations.where(k % 4 > 0).select(name.alias("url"), data.alias("html"))
    inventory = nations.select(F.concat(F.lit("prod"), k).alias("product_id"), name.alias("product_url"), F.lit(None).cast("string").alias("listing_page"), (k + 1).alias("listing_position"))
    folder = str(files.scratch(spark))
    run_catalogue(spark, lambda: inventory, runs.stored_pages(pages), POLICY, folder, {"collection": "nations"}, lambda: MOMENT, 9)
    found = files.json_document(spark, f"{folder}/checkpoint.json")
    row = (found["state"], len(found["parts"]), found["product_count"], found["inventory_product_count"], found["unresolved_product_count"], ",".join(found["completed_product_ids"]))
    return spark.createDataFrame([row], "state string, n_parts int, product_count int, inventory_product_count int, unresolved_product_count int, completed_product_ids string")


@R.query("SELECT count(*)::INT AS n_points, 13::INT AS n_slots, format('{:,} shades', count(*)) AS shown, true AS has_axes FROM part")
def map_file(spark, sf_dir):
    """The page of the colour map, written and read back."""
    path = files.scratch(spark) / "map.html"
    colour_map.write_map_page(color_map(spark, sf_dir), path)
    shown = F.max(F.regexp_extract("value", r"[\d,]+ shades", 0)).alias("shown")
    size = F.array_size("point")
    slots = F.when(F.min(size) == F.max(size), F.max(size)).alias("n_slots")
    return colour_map.page_lines(spark, path).agg(F.count("point").cast("int").alias("n_points"), slots, shown, F.bool_or(F.contains("value", F.lit('"x_low"'))).alias("has_axes"))


@R.query(r"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'State [' || p_name || ']' WHEN 1 THEN p_name || ' of a box' WHEN 2 THEN p_name || ' under a heading' END AS ingredients,
  'https://www.shop.example/i/' || CASE WHEN p_partkey % 2 = 0 THEN 'own.png' ELSE p_partkey || '_sw.png' END AS swatch, p_type AS variant_name FROM part""")
def page_details(spark, sf_dir):
    """Ingredients from the state before those of the page, the swatch of the SKU or one by its name, a variant's name from its swatch."""
    k, name = F.col("p_partkey"), F.col("p_name")
    data = F.concat(F.lit('<script type="application/ld+json">{"@type":"Product","productID":"prod'), k, F.lit('","sku":"'), k, F.lit('","name":"Thing"}</script>'))
    state = F.when(k % 4 == 0, F.concat(F.lit('<script>window.__APOLLO_STATE__ = {"a":{"ingredients":["no"]},"b":[{"ingredients":"State \\\\['), name, F.lit('\\\\]"}]};</script>'))).otherwise("")
    box = F.when(k % 4 < 2, F.concat(F.lit("<div data-test='ingredients'>Ingredients: "), name, F.lit(" of a box</div>"))).when(k % 4 == 2, F.concat(F.lit("<section><h3>Ingredients</h3><p>"), name, F.lit(" under a heading</p></section>"))).otherwise("")
    picture = F.when(k % 2 == 0, "<img src='/i/own.png'>").otherwise("")
    swatch = F.concat(F.lit("<div class='ProductSwatches ProductSwatches--content'><a href='?sku=none'><img src='/i/no.png' alt='no'></a><a href='?sku="), k, F.lit("'>"), F.col("p_type"), F.lit(" Thing"), picture, F.lit("</a></div>"))
    by_name = F.when(k % 2 == 1, F.concat(F.lit("<img src='/i/"), k, F.lit("_sw.png'>"))).otherwise("")
    pages = dealt_parts(spark, sf_dir).select(k, F.concat(F.lit("https://www.shop.example/p/a-prod"), k).alias("url"), F.concat(data, state, swatch, by_name, box).alias("html"))
    found = P.product_rows(P.raw_pages(pages, ("url", "p_partkey"), "product"), POLICY, ("p_partkey",))
    return found.select("p_partkey", "ingredient.ingredients", F.col("variant.swatch_image_url").alias("swatch"), "variant.variant_name")


@R.query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END AS value, CASE WHEN s_suppkey % 3 = 0 THEN 'ValueError: lab_l is missing or invalid for ' || s_suppkey END AS error FROM supplier WHERE s_suppkey % 3 > 0 OR s_suppkey = 3""")
def required_numbers(spark, sf_dir):
    """Numbers that must be there: those that are, and the error for one that isn't."""
    k = F.col("s_suppkey")
    suppliers = read(spark, sf_dir, "supplier").select(k, F.when(k % 3 == 0, "none").otherwise(F.col("s_acctbal").cast("string")).alias("lab_l"))
    number = text.required_number(F.col("lab_l"), "lab_l", k.cast("string"))
    good = suppliers.where("s_suppkey % 3 > 0").select("s_suppkey", number.alias("value"), F.lit(None).cast("string").alias("error"))
    try:
        suppliers.where("s_suppkey = 3").select(number.alias("x")).collect()
        error = "none"
    except Exception as raised:
        error = f"ValueError: {re.search('lab_l is missing or invalid for [0-9]+', str(raised))[0]}"
    return good.unionByName(spark.createDataFrame([(3, None, error)], "s_suppkey long, value double, error string"))


@R.query("SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 4 THEN NULL ELSE n_name || ' é' END AS html, CASE WHEN n_nationkey % 5 = 4 THEN 'ValueError' END AS error_type, n_nationkey % 5 = 3 AS again FROM nation")
def live_fetch(spark, sf_dir):
    """Pages of nations from a client whose server is busy at times, answers in another charset, or sends what isn't a page."""
    names, asked = {f"https://www.shop.example/{r['n_nationkey']}": (r["n_nationkey"], r["n_name"]) for r in read(spark, sf_dir, "nation").collect()}, []
    import io
    from urllib.error import HTTPError

    class Reply(io.BytesIO):
        def __init__(self, url, kind, content):
            super().__init__(content)
            self.headers, self.geturl = {"Content-Type": kind}, lambda: url

    def opener(request, timeout):
        k, name = names[request.full_url]
        asked.append(k)
        if k % 5 == 3 and asked.count(k) == 1:
            raise HTTPError(request.full_url, 503, "busy", {"Retry-After": "1"}, None)
        if k % 5 == 4:
            return Reply(request.full_url, "image/png", b"x")
        return Reply(request.full_url, "text/html; charset=latin-1" if k % 2 else "text/html", f"{name} é".encode("latin-1" if k % 2 else "utf-8"))

    client = http.Client(["www.shop.example"], "test", gap=0, opener=opener, sleep=lambda s: None)
    found = http.live_pages(spark, client)(spark.createDataFrame([(u,) for u in names], "url string")).collect()
    return spark.createDataFrame([(names[r["url"]][0], r["html"], r["error_type"], asked.count(names[r["url"]][0]) > 1) for r in found], "n_nationkey int, html string, error_type string, again boolean")
