"""The colour map: points from cleaned variants and colours, and the page that shows them."""

from __future__ import annotations

import html
import json
import shutil
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tintloom.functions import text
from tintloom.operators import pixels, snapshot
from tintloom.sources import files, sinks

# The columns that the two inputs must have.
VARIANT_COLUMNS = ("product_id", "sku_id", "brand", "product_name", "variant_name", "variant_url", "swatch_image_url", "variant_image_url", "effective_price", "size_value", "size_unit", "price_per_g_ml")
COLOR_COLUMNS = ("product_id", "sku_id", "hex_color", "lab_l", "lab_a", "lab_b")


def map_points(variants: DataFrame, colors: DataFrame) -> DataFrame:
    """One row per variant, in order of hue, lightness and SKU, with everything that the page shows of it."""
    snapshot.require_columns(variants, VARIANT_COLUMNS, "variants")
    snapshot.require_columns(colors, COLOR_COLUMNS, "colors")
    joined = snapshot.strict_join(variants, colors, "sku_id")
    sku = F.col("sku_id")
    numbers = {c: text.required_number(F.col(c), c, sku) for c in ("lab_l", "lab_a", "lab_b")}
    points = pixels.placed(joined.withColumns(numbers)).orderBy("hue_angle", "lab_l", "sku_id")
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return points.select(
        "sku_id", (text.fixed(F.col("hue_angle"), 3) + 0.0).alias("x"), (text.fixed(F.col("lab_l"), 3) + 0.0).alias("y"), "hex_color",
        text.named(F.col("brand"), "Unknown brand").alias("brand"), text.named(F.col("product_name"), "Unknown product").alias("product_name"),
        text.named(F.col("variant_name"), "Unnamed shade").alias("shade"), text.price_text(F.col("effective_price")).alias("price"),
        text.size_label(F.col("size_value"), F.col("size_unit")).alias("size"), text.unit_price_text(F.col("price_per_g_ml"), F.col("size_unit")).alias("unit_price"),
        empty("variant_url"), empty("variant_image_url"), empty("swatch_image_url"),
        *[(text.fixed(F.col(c), 2) + 0.0).alias(c) for c in ("chroma", "lab_a", "lab_b")],
    )


#: What the page shows of a point, in this order.
SLOTS = ("brand", "product_name", "shade", "price", "size", "unit_price", "variant_url", "variant_image_url", "swatch_image_url", "sku_id", "chroma", "lab_a", "lab_b")


def payload(points: DataFrame) -> DataFrame:
    """(sku_id, payload): the slots of every point, numbers as JSON writes them."""
    return points.select("sku_id", F.array(*[F.to_json(F.array(F.col(c))) if c in ("chroma", "lab_a", "lab_b") else F.col(c) for c in SLOTS]).alias("payload")).withColumn(
        "payload", F.transform("payload", lambda x, i: F.when(i >= 10, F.regexp_replace(x, r"[\[\]]", "")).otherwise(x))
    )


def axis_ranges(hue: Column, lightness: Column) -> list[Column]:
    """Aggregates x_low, x_high, y_low, y_high: whole numbers around all points, lightness within 0 and 100."""
    return [
        F.floor(F.min(hue) - 5).alias("x_low"), F.ceil(F.max(hue) + 5).alias("x_high"),
        F.greatest(F.lit(0), F.floor(F.min(lightness) - 4)).alias("y_low"), F.least(F.lit(100), F.ceil(F.max(lightness) + 4)).alias("y_high"),
    ]


PAGE = """<!DOCTYPE html>
<html lang="en"><head><meta charset="utf-8"><meta name="viewport" content="width=device-width, initial-scale=1"><title>{title}</title>
<style>body{{font-family:sans-serif;margin:1.5em}}.board{{display:flex;gap:1em;flex-wrap:wrap}}#map{{flex:3 1 40em;height:700px;border:1px solid #ddd;touch-action:none}}
#pin{{flex:1 1 16em;border:1px solid #ddd;padding:1em}}#pin img{{max-width:10em;display:block;margin-bottom:.5em}}.dot{{cursor:pointer}}text{{font-size:12px}}</style></head>
<body><h1>{title}</h1><p>{count} shades by hue and lightness. Drag to move, turn the wheel to zoom, click to pin.</p>
<div class="board"><svg id="map" viewBox="0 0 1000 700"></svg><section id="pin" aria-live="polite">Click a shade to pin its details.</section></div>
<script>
const points = {points}, area = {area};
const slots = {slots};
const svg = document.getElementById("map"), pin = document.getElementById("pin"), space = "http://www.w3.org/2000/svg";
const make = (name, values, parent) => {{
  const e = document.createElementNS(space, name);
  for (const [k, v] of Object.entries(values)) e.setAttribute(k, v);
  parent.append(e);
  return e;
}};
const px = x => 60 + (x - area.x_low) / (area.x_high - area.x_low) * 920, py = y => 650 - (y - area.y_low) / (area.y_high - area.y_low) * 630;
const board = make("g", {{}}, svg);
for (let k = 0; k <= 8; k++) {{
  const x = area.x_low + k / 8 * (area.x_high - area.x_low), y = area.y_low + k / 8 * (area.y_high - area.y_low);
  make("line", {{x1: px(x), x2: px(x), y1: 20, y2: 650, stroke: "#eee"}}, board);
  make("line", {{x1: 60, x2: 980, y1: py(y), y2: py(y), stroke: "#eee"}}, board);
  make("text", {{x: px(x) - 10, y: 668}}, board).textContent = x.toFixed(0);
  make("text", {{x: 25, y: py(y) + 4}}, board).textContent = y.toFixed(0);
}}
make("text", {{x: 450, y: 692}}, board).textContent = "hue in degrees";
make("text", {{x: 8, y: 14}}, board).textContent = "lightness";
const picture = (url, words) => {{
  if (!/^https?:/.test(url)) return;
  const image = document.createElement("img");
  image.src = url;
  image.alt = words;
  pin.append(image);
}};
const show = (p, d) => {{
  pin.replaceChildren();
  picture(d.variant_image_url, d.product_name);
  picture(d.swatch_image_url, d.shade);
  for (const line of [d.brand, d.product_name, d.shade, d.price, d.size, d.unit_price, `${{p[2]}}, hue ${{p[0].toFixed(1)}}, lightness ${{p[1].toFixed(1)}}, chroma ${{Number(d.chroma).toFixed(1)}}`, `SKU ${{d.sku_id}}`]) {{
    const row = document.createElement("div");
    row.textContent = line;
    pin.append(row);
  }}
  if (d.variant_url.startsWith("https://")) {{
    const link = document.createElement("a");
    link.href = d.variant_url;
    link.rel = "noopener";
    link.textContent = "Open the product";
    pin.append(link);
  }}
}};
for (const p of points) {{
  const d = Object.fromEntries(slots.map((s, i) => [s, p[3][i]]));
  const dot = make("circle", {{cx: px(p[0]), cy: py(p[1]), r: 5, fill: p[2], "fill-opacity": 0.8, stroke: "#2226", class: "dot"}}, board);
  make("title", {{}}, dot).textContent = [d.brand, d.product_name, d.shade, d.price, d.size, d.unit_price].join("\\n");
  dot.addEventListener("click", () => show(p, d));
}}
const view = {{x: 0, y: 0, k: 1}};
const place = () => board.setAttribute("transform", `translate(${{view.x}} ${{view.y}}) scale(${{view.k}})`);
svg.addEventListener("wheel", e => {{ e.preventDefault(); view.k = Math.min(40, Math.max(1, view.k * (e.deltaY < 0 ? 1.2 : 1 / 1.2))); place(); }}, {{passive: false}});
svg.addEventListener("pointermove", e => {{ if (e.buttons) {{ view.x += e.movementX; view.y += e.movementY; place(); }} }});
</script></body></html>
"""


def point_lines(points: DataFrame) -> DataFrame:
    """(line): every point as the page's script has it, a JSON array on a line of its own, in the order of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shown = ([r["x"], r["y"], r["hex_color"], [r[s] for s in SLOTS]] for r in batch.to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([json.dumps(r, ensure_ascii=False).replace("</", "<\\/") for r in shown], pa.string())], ["line"])

    return points.select("x", "y", "hex_color", *SLOTS).mapInArrow(run, "line string")


def _around(points: DataFrame, title: str) -> list[str]:
    """What the page has before its points and after them; an error without points."""
    area = points.agg(F.count(F.lit(1)).alias("n"), *axis_ranges(F.col("x"), F.col("y"))).first().asDict()
    if not (n := area.pop("n")):
        raise ValueError("there are no points to show")
    mark = "\0"
    return PAGE.format(title=html.escape(title), count=f"{n:,}", points=f"[\n{mark}\n]", area=json.dumps(area), slots=json.dumps(SLOTS)).split(mark)


def map_page(points: DataFrame, title: str = "Colour map") -> str:
    """The page for points of `map_points`, whole in itself and in memory (`write_map_page` streams it); an error without points."""
    head, tail = _around(points, title)
    return head + ",\n".join(r["line"] for r in point_lines(points).toLocalIterator()) + tail


def write_map_page(points: DataFrame, path: str | Path, title: str = "Colour map") -> None:
    """The page of `map_page` as a file: executors write its lines to shared storage, the driver joins them block by block."""
    head, tail = _around(points, title)
    work = files.scratch(points.sparkSession)

    def write(temporary: Path) -> None:
        with temporary.open("wb") as out:
            out.write(head.encode())
            ended = False
            for part in sorted((work / "lines").glob("part-*")):
                with part.open("rb") as lines:
                    while block := lines.read(1 << 20):
                        # The last line's end isn't followed by another line, so it is held back.
                        out.write((b",\n" if ended else b"") + block.removesuffix(b"\n").replace(b"\n", b",\n"))
                        ended = block.endswith(b"\n")
            out.write(tail.encode())

    try:
        point_lines(points).write.text(f"file://{work}/lines", lineSep="\n")
        sinks.replace(Path(path), write)
    finally:
        shutil.rmtree(work, ignore_errors=True)


def page_lines(spark: SparkSession, path: str | Path) -> DataFrame:
    """(value, point) of every line of a page that is written; `point` is its slots where it is a point's, else null."""
    lines = spark.read.text(f"file://{Path(path).absolute()}", lineSep="\n")
    whole = F.from_json(F.when(F.col("value").startswith("["), F.regexp_replace("value", ",$", "")), "array<string>")
    return lines.select("value", F.from_json(F.get(whole, F.lit(3)), "array<string>").alias("point"))
