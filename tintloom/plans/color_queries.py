"""Queries for colour science, pixel measurement, the strict join and the colour map."""

from __future__ import annotations

from pyspark.sql import functions as F

from tintloom.functions import color, text
from tintloom.operators import pixels, snapshot
from tintloom.plans import colour_map
from tintloom.plans.colour_map import map_points
from tintloom.plans.tables import Registry, read

R = Registry()
RGB_SQL = "(p_partkey * 37 % 256)::INT AS r, (p_partkey * 91 % 256)::INT AS g, CASE WHEN p_partkey % 9 = 0 THEN p_partkey * 37 % 256 ELSE p_partkey * 53 % 256 END::INT AS b"
LIN_SQL = "CASE WHEN {0} / 255.0::DOUBLE <= 0.04045 THEN {0} / 255.0::DOUBLE / 12.92 ELSE pow(({0} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) END"
CURVE_SQL = "CASE WHEN {0} > pow(6.0::DOUBLE / 29, 3) THEN pow({0}, 1.0::DOUBLE / 3) ELSE {0} / (3 * pow(6.0::DOUBLE / 29, 2)) + 4.0::DOUBLE / 29 END"


def lab_sql(source: str) -> str:
    """CTEs that add lab_l, lab_a and lab_b, rounded, to a relation with r, g and b."""
    return f"""lin AS (SELECT *, {LIN_SQL.format("r")} AS lr, {LIN_SQL.format("g")} AS lg, {LIN_SQL.format("b")} AS lb FROM {source}),
  xyz AS (SELECT *, (lr * 0.4124564 + lg * 0.3575761 + lb * 0.1804375) / 0.95047 AS x, lr * 0.2126729 + lg * 0.7151522 + lb * 0.0721750 AS y, (lr * 0.0193339 + lg * 0.1191920 + lb * 0.9503041) / 1.08883 AS z FROM lin),
  f AS (SELECT *, {CURVE_SQL.format("x")} AS fx, {CURVE_SQL.format("y")} AS fy, {CURVE_SQL.format("z")} AS fz FROM xyz),
  lab AS (SELECT *, format('{{:.2f}}', 116 * fy - 16)::DOUBLE AS lab_l, format('{{:.2f}}', 500 * (fx - fy))::DOUBLE AS lab_a, format('{{:.2f}}', 200 * (fy - fz))::DOUBLE AS lab_b FROM f)"""


PART_LAB_SQL = f"WITH rgb AS (SELECT *, {RGB_SQL} FROM part), {lab_sql('rgb')}"


def part_rgb(spark, sf_dir):
    """Parts with a colour that follows from their key; every ninth has equal red and blue."""
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").withColumns({"r": (k * 37 % 256).cast("int"), "g": (k * 91 % 256).cast("int"), "b": F.when(k % 9 == 0, k * 37 % 256).otherwise(k * 53 % 256).cast("int")})


def part_colors(spark, sf_dir):
    found = part_rgb(spark, sf_dir).withColumn("lab", color.lab_rounded(F.col("r"), F.col("g"), F.col("b")))
    return found.select("*", "lab.*", color.hex_color(F.col("r"), F.col("g"), F.col("b")).alias("hex_color")).drop("lab")


@R.query("""SELECT p_partkey, greatest(1, round_even(p_size * 20 * 0.2::DOUBLE, 0))::INT AS side, floor((p_size * 20 - greatest(1, round_even(p_size * 20 * 0.2::DOUBLE, 0))) / 2)::INT AS "offset" FROM part""")
def crop_geometry(spark, sf_dir):
    return read(spark, sf_dir, "part").withColumn("c", color.crop(F.col("p_size") * 20, 0.2)).select("p_partkey", "c.*")


@R.query(f"WITH rgb AS (SELECT *, {RGB_SQL} FROM part) SELECT p_partkey, format('{{:.6f}}', {LIN_SQL.format('r')})::DOUBLE AS linear_r FROM rgb")
def srgb_linear(spark, sf_dir):
    return part_rgb(spark, sf_dir).select("p_partkey", text.fixed(color.linear(F.col("r")), 6).alias("linear_r"))


@R.query(f"{PART_LAB_SQL} SELECT p_partkey, lab_l + 0.0 AS lab_l, lab_a + 0.0 AS lab_a, lab_b + 0.0 AS lab_b FROM lab")
def srgb_to_lab(spark, sf_dir):
    return part_colors(spark, sf_dir).select("p_partkey", *[(F.col(c) + 0.0).alias(c) for c in ("lab_l", "lab_a", "lab_b")])


@R.query(f"WITH rgb AS (SELECT *, {RGB_SQL} FROM part) SELECT p_partkey, format('#{{:02x}}{{:02x}}{{:02x}}', r, g, b) AS hex_color FROM rgb")
def hex_color(spark, sf_dir):
    return part_colors(spark, sf_dir).select("p_partkey", "hex_color")


@R.query(f"{PART_LAB_SQL} SELECT p_partkey, format('{{:.3f}}', degrees(atan2(lab_b, lab_a)))::DOUBLE + 0.0 AS hue_angle, format('{{:.3f}}', sqrt(lab_a * lab_a + lab_b * lab_b))::DOUBLE + 0.0 AS chroma FROM lab")
def hue_chroma(spark, sf_dir):
    return pixels.placed(part_colors(spark, sf_dir)).select("p_partkey", (text.fixed(F.col("hue_angle"), 3) + 0.0).alias("hue_angle"), text.fixed(F.col("chroma"), 3).alias("chroma"))


GREYS_SQL = "WITH rgb AS (SELECT v::INT AS v, v::INT AS r, v::INT AS g, v::INT AS b FROM (SELECT DISTINCT p_partkey % 256 AS v FROM part))"


@R.query(f"{GREYS_SQL}, {lab_sql('rgb')} SELECT v, format('{{:.3f}}', degrees(atan2(lab_b, lab_a)))::DOUBLE + 0.0 AS hue_angle FROM lab")
def grey_hues(spark, sf_dir):
    """The hue of greys hangs on the sign of a rounded zero."""
    greys = read(spark, sf_dir, "part").select((F.col("p_partkey") % 256).cast("int").alias("v")).distinct()
    found = greys.withColumn("lab", color.lab_rounded(F.col("v"), F.col("v"), F.col("v"))).select("v", "lab.*")
    return pixels.placed(found).select("v", (text.fixed(F.col("hue_angle"), 3) + 0.0).alias("hue_angle"))


@R.query(f"""{PART_LAB_SQL}, h AS (SELECT degrees(atan2(lab_b, lab_a)) AS h, lab_l FROM lab)
  SELECT floor(min(h) - 5)::BIGINT AS x_low, ceil(max(h) + 5)::BIGINT AS x_high, greatest(0, floor(min(lab_l) - 4))::BIGINT AS y_low, least(100, ceil(max(lab_l) + 4))::BIGINT AS y_high FROM h""")
def axis_ranges(spark, sf_dir):
    return pixels.placed(part_colors(spark, sf_dir)).agg(*colour_map.axis_ranges(F.col("hue_angle"), F.col("lab_l")))


PIXELS_SQL = "SELECT l_orderkey AS k, (l_partkey * 7 % 256)::INT AS r, (240 + l_suppkey % 16)::INT AS g, (250 - l_linenumber)::INT AS b, (l_quantity * 5)::INT AS a FROM lineitem"
SHOWN_SQL = "NOT (r >= 245 AND g >= 245 AND b >= 245)"
SAMPLE_SQL = f"""px AS ({PIXELS_SQL}), seen AS (SELECT * FROM px WHERE a > 15),
  n AS (SELECT k, count(*) AS n_all, count(*) FILTER ({SHOWN_SQL}) AS n_fg FROM seen GROUP BY k),
  s AS (SELECT seen.* FROM seen JOIN n USING (k) WHERE n_fg < greatest(1, ceil(n_all * 0.05::DOUBLE)) OR {SHOWN_SQL}),
  m AS (SELECT k, count(*) AS sample_pixel_count, trunc(median(r))::INT AS rgb_r, trunc(median(g))::INT AS rgb_g, trunc(median(b))::INT AS rgb_b FROM s GROUP BY k)"""


def line_pixels(spark, sf_dir):
    """Lines of an order as its pixels."""
    lines = read(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").alias("k"), (F.col("l_partkey") * 7 % 256).cast("int").alias("r"), (240 + F.col("l_suppkey") % 16).cast("int").alias("g"), (250 - F.col("l_linenumber")).cast("int").alias("b"), (F.col("l_quantity") * 5).cast("int").alias("a"))


@R.query(f"WITH px AS ({PIXELS_SQL}) SELECT k, count(*) AS visible, count(*) FILTER ({SHOWN_SQL}) AS shown FROM px WHERE a > 15 GROUP BY k")
def pixel_filter(spark, sf_dir):
    shown = ~((F.col("r") >= 245) & (F.col("g") >= 245) & (F.col("b") >= 245))
    return line_pixels(spark, sf_dir).where(F.col("a") > pixels.ALPHA).groupBy("k").agg(F.count(F.lit(1)).alias("visible"), F.count_if(shown).alias("shown"))


@R.query(f"WITH {SAMPLE_SQL} SELECT k, sample_pixel_count FROM m")
def foreground_fallback(spark, sf_dir):
    return pixels.measure(line_pixels(spark, sf_dir), ["k"]).select("k", "sample_pixel_count")


@R.query(f"WITH {SAMPLE_SQL} SELECT k, rgb_r, rgb_g, rgb_b FROM m")
def pixel_median(spark, sf_dir):
    return pixels.measure(line_pixels(spark, sf_dir), ["k"]).select("k", "rgb_r", "rgb_g", "rgb_b")


@R.query(f"WITH {SAMPLE_SQL} SELECT k, format('{{:.2f}}', sqrt(sum(pow(r - rgb_r, 2) + pow(g - rgb_g, 2) + pow(b - rgb_b, 2)) / count(*)))::DOUBLE AS rgb_spread FROM s JOIN m USING (k) GROUP BY k")
def rgb_spread(spark, sf_dir):
    return pixels.measure(line_pixels(spark, sf_dir), ["k"]).select("k", "rgb_spread")


@R.query(f"""WITH {SAMPLE_SQL}, rgb AS (SELECT k, sample_pixel_count, rgb_r AS r, rgb_g AS g, rgb_b AS b FROM m), {lab_sql("rgb")}
  SELECT k, sample_pixel_count, format('#{{:02x}}{{:02x}}{{:02x}}', r, g, b) AS hex_color, lab_l + 0.0 AS lab_l, lab_a + 0.0 AS lab_a, lab_b + 0.0 AS lab_b FROM lab""")
def swatch_measure(spark, sf_dir):
    found = pixels.measure(line_pixels(spark, sf_dir), ["k"])
    return found.select("k", "sample_pixel_count", "hex_color", *[(F.col(c) + 0.0).alias(c) for c in ("lab_l", "lab_a", "lab_b")])


@R.query(f"{PART_LAB_SQL} SELECT 'sku' || p_partkey AS sku_id, p_name, format('#{{:02x}}{{:02x}}{{:02x}}', r, g, b) AS hex_color FROM lab")
def strict_join(spark, sf_dir):
    variants = read(spark, sf_dir, "part").select(F.concat(F.lit(" sku"), F.col("p_partkey"), F.lit(" ")).alias("sku_id"), "p_name")
    colors = part_colors(spark, sf_dir).select(F.concat(F.lit("sku"), F.col("p_partkey")).alias("sku_id"), "hex_color")
    return snapshot.strict_join(variants, colors, "sku_id")


@R.query("""WITH l AS (SELECT trim(CASE WHEN p_partkey % 50 = 0 THEN '' ELSE (p_partkey // 2)::VARCHAR END) AS k, count(*) AS l FROM part GROUP BY 1), r AS (SELECT s_suppkey::VARCHAR AS k, count(*) AS r FROM supplier GROUP BY 1),
  j AS (SELECT coalesce(l.k, r.k) AS k, l, r FROM l FULL JOIN r ON l.k = r.k)
  SELECT count(*) FILTER (k = '') AS empty_keys, count(*) FILTER (l > 1 AND k <> '') AS left_repeated, count(*) FILTER (r > 1 AND k <> '') AS right_repeated,
         count(*) FILTER (r IS NULL AND k <> '') AS left_only, count(*) FILTER (l IS NULL AND k <> '') AS right_only FROM j""")
def join_audit(spark, sf_dir):
    left = read(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 50 == 0, " ").otherwise(F.floor(F.col("p_partkey") / 2).cast("string")).alias("k"))
    return snapshot.join_audit(left, read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), "k")


@R.query("SELECT p_size, s_name AS name, s_suppkey::VARCHAR AS k FROM part JOIN supplier ON s_suppkey = p_partkey")
def right_bias_merge(spark, sf_dir):
    left = read(spark, sf_dir, "part").select(F.concat(F.lit(" "), F.col("p_partkey")).alias("k"), F.col("p_name").alias("name"), "p_size")
    right = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("k"), F.col("s_name").alias("name"))
    return snapshot.right_biased(left, right, "k")


UNITS = ("g", "mL", "fl oz", "oz")


def cleaned_parts(spark, sf_dir):
    """Parts as cleaned variants of a catalogue."""
    sku, k = F.concat(F.lit("sku"), F.col("p_partkey")), F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        F.concat(F.lit("prod"), k % 97).alias("product_id"), sku.alias("sku_id"), F.when(k % 11 > 0, F.col("p_brand")).alias("brand"), F.col("p_name").alias("product_name"),
        F.when(k % 13 > 0, F.col("p_type")).otherwise("").alias("variant_name"), F.concat(F.lit("https://www.shop.example/p/x?sku="), k).alias("variant_url"),
        F.lit(None).cast("string").alias("swatch_image_url"), F.lit("").alias("variant_image_url"), F.when(k % 7 > 0, F.col("p_retailprice")).alias("effective_price"),
        F.col("p_size").alias("size_value"), F.element_at(F.array(*map(F.lit, UNITS)), (k % 4 + 1).cast("int")).alias("size_unit"), (F.col("p_retailprice") / F.col("p_size")).alias("price_per_g_ml"),
    )


@R.query(f"""{PART_LAB_SQL}, m AS (SELECT *, degrees(atan2(lab_b, lab_a)) AS h, sqrt(lab_a * lab_a + lab_b * lab_b) AS c FROM lab)
  SELECT 'sku' || p_partkey AS sku_id, format('{{:.3f}}', h)::DOUBLE + 0.0 AS x, format('{{:.3f}}', lab_l)::DOUBLE + 0.0 AS y, format('#{{:02x}}{{:02x}}{{:02x}}', r, g, b) AS hex_color,
    CASE WHEN p_partkey % 11 > 0 THEN p_brand ELSE 'Unknown brand' END AS brand, p_name AS product_name, CASE WHEN p_partkey % 13 > 0 THEN p_type ELSE 'Unnamed shade' END AS shade,
    CASE WHEN p_partkey % 7 > 0 THEN '$' || format('{{:,.2f}}', p_retailprice) ELSE 'Not available' END AS price, p_size || ' ' || ['g', 'mL', 'fl oz', 'oz'][(p_partkey % 4 + 1)::INT] AS size,
    '$' || format('{{:,.2f}}', p_retailprice / p_size) || CASE WHEN p_partkey % 4 IN (1, 2) THEN '/mL' ELSE '/g' END AS unit_price,
    'https://www.shop.example/p/x?sku=' || p_partkey AS variant_url, '' AS variant_image_url, '' AS swatch_image_url, format('{{:.2f}}', c)::DOUBLE + 0.0 AS chroma,
    lab_a + 0.0 AS lab_a, lab_b + 0.0 AS lab_b FROM m""")
def color_map(spark, sf_dir):
    """The points of the colour map over all parts: strict join, hue and chroma, labels, three-key order."""
    colors = part_colors(spark, sf_dir).select(F.concat(F.lit("prod"), F.col("p_partkey") % 97).alias("product_id"), F.concat(F.lit("sku"), F.col("p_partkey")).alias("sku_id"), "hex_color", "lab_l", "lab_a", "lab_b")
    return map_points(cleaned_parts(spark, sf_dir), colors)


def _payload_sql() -> str:
    return f"""SELECT sku_id, [brand, product_name, shade, price, size, unit_price, variant_url, variant_image_url, swatch_image_url, sku_id,
      chroma::VARCHAR, lab_a::VARCHAR, lab_b::VARCHAR]::VARCHAR[] AS payload FROM ({R.oracles["color_map"]})"""


@R.query(_payload_sql())
def hover_payload(spark, sf_dir):
    return colour_map.payload(color_map(spark, sf_dir))
