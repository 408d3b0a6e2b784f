import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tintloom import cli, config
from tintloom.functions.urls import HostPolicy
from tintloom.operators import cleaning, runs, snapshot
from tintloom.plans.colour_map import COLOR_COLUMNS, VARIANT_COLUMNS, map_page, map_points
from tintloom.sources import files, http, images, sinks

MEDIA = "https://media.shop.example/i/"


def png(width, height, pixel):
    """An RGBA PNG whose pixel (x, y) is pixel(x, y)."""
    raw = b"".join(b"\0" + b"".join(bytes(pixel(x, y)) for x in range(width)) for y in range(height))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("é\nx", None, 'q"q'), ("", "Città", "b")], "a string, b string, c string")
    sinks.write_csv_file(rows, tmp_path / "d/t.csv", ["c", "a", "b"])
    assert (tmp_path / "d/t.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    again = files.csv_table(spark, str(tmp_path / "d/t.csv"), ["a", "c"])
    assert {tuple(r) for r in again.collect()} == {('q"q', "é\nx", None), ("b", None, "Città")}
    with pytest.raises(snapshot.ContractError, match="lacks columns: z"):
        files.csv_table(spark, str(tmp_path / "d/t.csv"), ["z"])
    with pytest.raises(FileNotFoundError):
        files.csv_table(spark, str(tmp_path / "none.csv"), [])
    assert files.csv_rows(spark, str(tmp_path / "none.csv"), ["a"]).columns == ["a"]
    assert files.json_document(spark, str(tmp_path / "none.json")) == {}
    sinks.write_json_file({"é": 1}, tmp_path / "m.json")
    assert files.json_document(spark, str(tmp_path / "m.json")) == {"é": 1} and "é" in (tmp_path / "m.json").read_text()


def test_swatch_input(spark):
    make = lambda *rows: files.swatch_input(spark.createDataFrame(list(rows), "sku_id string, swatch_image_url string"), HostPolicy())
    assert {tuple(r) for r in make((" 1", MEDIA + "a "), ("1", MEDIA + "a"), ("2", MEDIA + "b")).collect()} == {("1", MEDIA + "a"), ("2", MEDIA + "b")}
    for bad in ([("1", MEDIA + "a"), ("1", MEDIA + "b")], [("", MEDIA + "a")], [("1", None)], [("1", "http://media.shop.example/a")]):
        with pytest.raises(snapshot.ContractError):
            make(*bad)


def test_decoding(spark):
    frame = spark.createDataFrame([(1, bytearray("Crème".encode()), "utf-8"), (2, bytearray("Crème".encode("latin-1")), "ISO-8859-1"), (3, bytearray(b"\xff\xfe\xff"), "none"), (4, bytearray("e\u0301".encode()), None)], "i int, c binary, n string")
    found = dict(frame.select("i", files.decoded_html(F.col("c"), F.col("n"))).collect())
    assert found == {1: "Crème", 2: "Crème", 3: None, 4: "é"}
    assert spark.range(1).select(files.declared_charset(F.lit('text/html; Charset="UTF-8"'))).first()[0] == "utf-8"


def test_images(spark, tmp_path):
    folder = tmp_path / "img"
    folder.mkdir()
    (folder / "solid.png").write_bytes(png(10, 10, lambda x, y: (200, 30, 60, 255)))
    (folder / "white.png").write_bytes(png(10, 10, lambda x, y: (10, 20, 31, 255) if (x, y) == (4, 4) else (255, 255, 255, 255)))
    (folder / "clear.png").write_bytes(png(10, 10, lambda x, y: (1, 2, 3, 0)))
    (folder / "tiny.png").write_bytes(png(1, 1, lambda x, y: (255, 255, 255, 255)))
    (folder / "even.png").write_bytes(png(10, 10, lambda x, y: (10 + x % 2, 0, 0, 255)))
    (folder / "bad.png").write_bytes(b"no image")
    found = {r.path.rsplit("/", 1)[-1]: r for r in images.measure_images(images.image_files(spark, str(folder))).collect()}
    assert found["solid.png"].hex_color == "#c81e3c" and found["solid.png"].sample_pixel_count == 4 and found["solid.png"].rgb_spread == 0.0
    assert found["white.png"].hex_color == "#0a141f" and found["white.png"].sample_pixel_count == 1
    assert found["tiny.png"].hex_color == "#ffffff" and found["even.png"].rgb_r == 10 and found["even.png"].rgb_spread == 0.71
    assert found["clear.png"].error == "the crop has no visible pixels" and found["bad.png"].error == "not a readable image"
    assert images.file_sha256(spark, str(folder / "solid.png")) == found["solid.png"].image_sha256
    raster = images.image_files(spark, str(folder)).withColumn("swatch_image_url", F.concat(F.lit(MEDIA), F.element_at(F.split("path", "/"), -1)))
    swatches = spark.createDataFrame([("p", "1", MEDIA + "solid.png"), ("p", "2", MEDIA + "bad.png"), ("p", "3", MEDIA + "gone.png")], "product_id string, sku_id string, swatch_image_url string")
    good, bad = runs.color_run(swatches, raster)
    assert [r.sku_id for r in good.collect()] == ["1"] and {r.sku_id for r in bad.collect()} == {"2", "3"}
    again, _ = runs.color_run(swatches, raster, good)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in good.collect()}
    with pytest.raises(snapshot.ContractError):
        runs.color_run(swatches.where("sku_id = '2'"), raster, good)


def test_cleaning(spark):
    sizes = {t: tuple(spark.range(1).select(cleaning.size(F.lit(t)).alias("s")).first().s) for t in ("0.12 (x2) oz", ".56 oz", "Color: Light", "1.0 fl oz", "5 g")}
    assert sizes == {"0.12 (x2) oz": (0.24, "oz"), ".56 oz": (0.56, "oz"), "Color: Light": (None, None), "1.0 fl oz": (1.0, "fl oz"), "5 g": (5.0, "g")}


def test_map_page(spark):
    variants = spark.createDataFrame([("p", "1", "B", "</script>", None, "https://x", None, None, 1234.5, 2.0, "mL", 3.0)], f"{', '.join(f'{c} string' for c in VARIANT_COLUMNS[:8])}, effective_price double, size_value double, size_unit string, price_per_g_ml double")
    colors = spark.createDataFrame([("p", "1", "#010203", "50.0", "1.0", "-1.0")], ", ".join(f"{c} string" for c in COLOR_COLUMNS))
    point = map_points(variants, colors).first()
    assert (point.x, point.price, point.size, point.unit_price, point.shade) == (-45.0, "$1,234.50", "2.0 mL", "$3.00/mL", "Unnamed shade")
    page = map_page(map_points(variants, colors))
    assert "1 shades" in page and page.count("</script>") == 1


def test_map_page_is_written_without_its_points_in_the_driver(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from tintloom.plans import catalog, colour_map

    found = spark.range(2500, numPartitions=7).select(F.col("id").alias("x"), (F.col("id") % 90).alias("y"), F.lit("#010203").alias("hex_color"), *[F.format_string('"%s"\n%s</b', F.lit(s), "id").alias(s) for s in colour_map.SLOTS])
    points = found.where("x < 1000 or x > 1600").orderBy("x")
    page = map_page(points)
    monkeypatch.setattr(DataFrame, "toLocalIterator", lambda *_, **__: pytest.fail("rows come to the driver"))
    colour_map.write_map_page(points, tmp_path / "map.html")
    assert (tmp_path / "map.html").read_text() == page
    shown = json.loads(page.partition("const points = ")[2].partition(", area = ")[0])
    assert [p[0] for p in shown] == [*range(1000), *range(1601, 2500)] and shown[0][3][0] == '"brand"\n0</b'
    assert catalog.QUERIES["map_file"](spark, "/root/testdata/sf0.001").first().n_points > 0


class Reply:
    def __init__(self, url, kind, data):
        self.url, self.headers, self.data = url, {"Content-Type": kind}, data

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass

    def geturl(self):
        return self.url

    def read(self, n):
        part, self.data = self.data[:n], self.data[n:]
        return part


def test_http_client():
    import urllib.error

    waits, calls = [], []

    def opener(request, timeout):
        calls.append(request.full_url)
        if len(calls) == 1:
            raise urllib.error.HTTPError(request.full_url, 503, "busy", {}, None)
        return Reply("https://a.example/x" if "moved" not in request.full_url else "https://b.example/x", "text/html; charset=utf-8", b"x" * 10)

    client = http.Client(["a.example"], "test", gap=5, opener=opener, sleep=waits.append)
    assert client.page("https://a.example/x")[0] == b"x" * 10
    assert len(calls) == 2 and 0.75 in waits
    with pytest.raises(ValueError, match="not an allowed address"):
        client.page("https://a.example/moved")
    with pytest.raises(ValueError, match="not an allowed address"):
        client.page("http://a.example/x")
    with pytest.raises(ValueError, match="not image/"):
        client.image("https://a.example/x")
    with pytest.raises(ValueError, match="more than 5 bytes"):
        client.page("https://a.example/x", most=5)


def test_config(tmp_path):
    (tmp_path / "s.toml").write_text("[scraper]\nmax_pages = 7\n")
    (tmp_path / "c.toml").write_text('[collections.b]\nsource_url = "https://www.shop.example/shop/b"\n[collections.a]\nsource_url = "https://www.shop.example/p/a-prod1"\n')
    hosts = ("shop.example", "www.shop.example")
    assert config.collection_names(tmp_path / "c.toml") == ["a", "b"]
    found = config.load_collection(tmp_path / "s.toml", tmp_path / "c.toml", "a", hosts)
    assert found.resolved_type == "product" and found.settings.max_pages == 7 and found.to_dict()["resolved_source_type"] == "product"
    with pytest.raises(ValueError, match="there are: a, b"):
        config.load_collection(tmp_path / "s.toml", tmp_path / "c.toml", "z", hosts)
    for bad in ({"name": "A"}, {"source_url": "http://shop.example/shop/x"}, {"source_url": "https://else.example/shop/x"}, {"source_type": "x"}, {"source_type": "product"}):
        with pytest.raises(ValueError):
            config.Collection(**({"name": "a", "source_url": "https://shop.example/shop/x", "hosts": hosts} | bad))
    with pytest.raises(ValueError):
        config.Settings(max_pages=0)


def test_command_line(spark, tmp_path):
    from test_pages import BASE, page, product

    start = "https://www.shop.example/shop/face"
    spark.createDataFrame([(start, f'<a href="{BASE}">a</a>'), (BASE, page(product()))], "url string, html string").write.parquet(str(tmp_path / "pages"))
    (tmp_path / "s.toml").write_text("[scraper]\n")
    (tmp_path / "c.toml").write_text(f'[collections.face]\nsource_url = "{start}"\n')
    args = ["catalogue", "face", "--settings", f"{tmp_path}/s.toml", "--collections", f"{tmp_path}/c.toml", "--pages", f"{tmp_path}/pages", "--output", f"{tmp_path}/run", "--host", "www.shop.example"]
    assert cli.main(args, spark) == 0
    manifest = json.loads((tmp_path / "run/run_manifest.json").read_text())
    assert manifest["status"] == "complete" and manifest["variants"] == 1 and manifest["unresolved"] == 0
    assert cli.main([*args[:1], "none", *args[2:]], spark) == 2
    sinks.check_resume(manifest, {k: manifest[k] for k in ("schema_version", "collection", "source_url")})
    with pytest.raises(snapshot.ContractError):
        sinks.check_resume(manifest, {"schema_version": 2, "collection": "face", "source_url": start})


def test_stream(spark, tmp_path):
    from test_pages import BASE, page, product

    from tintloom.streaming.pages import SCHEMA, parse_stream

    def add(*rows):
        spark.createDataFrame([(u, h, None) for u, h in rows], SCHEMA).selectExpr("url", "html", "timestamp'2026-01-01' as fetched_at").write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        parse_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", HostPolicy()).awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").count()

    add((BASE, page(product())), (BASE, page(product())))
    assert run() == 1
    add((BASE, page(product())), (BASE.replace("11", "12"), page(product("12"))))
    assert run() == 2


def test_catalogue_run_is_committed_in_batches_and_resumed(spark, tmp_path):
    from test_pages import page, product

    from tintloom.plans.catalogue_run import run_catalogue
    from tintloom.sources.sinks import RunFolder

    policy, at = HostPolicy(), "https://www.shop.example/p/x-prod{}?sku={}"
    named = lambda p, s, body="": page(product(s, productID=f"prod{p}"), body)
    more = lambda *urls: f'<div class="ProductSwatches--content">{"".join(f"<a href={chr(34)}{u}{chr(34)}>x</a>" for u in urls)}</div>'
    pages = {
        at.format(1, 11): named(1, "11", more(at.format(1, 11), at.format(1, 12), at.format(9, 12), at.format(1, 13))),
        at.format(1, 12): named(1, "12"), at.format(2, 21): "<p>broken</p>", at.format(3, 31): named(3, "31", more(at.format(3, 31), at.format(8, 11))),
    }
    asked = []

    def source(addresses):
        asked.append(sorted(r.url for r in addresses.select("url").distinct().collect()))
        return runs.stored_pages(spark.createDataFrame(list(pages.items()), "url string, html string"))(addresses)

    inventory = lambda: spark.createDataFrame([(f"prod{i}", at.format(i, i * 10 + 1), None, i) for i in (1, 2, 3)], "product_id string, product_url string, listing_page string, listing_position int")
    identity, folder = {"schema_version": 2, "collection": "c", "source_url": "u"}, str(tmp_path / "run")
    found = run_catalogue(spark, inventory, source, policy, folder, identity, lambda: "2026-01-01T00:00:00Z", 1)
    assert (found["status"], found["completed_product_count"], found["unresolved_product_count"], found["variant_count"], found["failure_attempt_count"]) == ("partial", 1, 2, 3, 2)
    # The second address of SKU 12 and the other product's address of SKU 11 aren't read.
    assert asked == [[at.format(1, 11)], [at.format(1, 12), at.format(1, 13), at.format(9, 12)], [at.format(2, 21)], [], [at.format(3, 31)], []]
    failures = {(r.stage, r.product_id, r.error_type) for r in RunFolder(spark, folder).table("failures").collect()}
    assert failures == {("variant", "prod1", "LookupError"), ("product", "prod2", "ParseError")}
    state = json.loads((tmp_path / "run/checkpoint.json").read_text())
    assert state["completed_product_ids"] == ["prod3"] and len(state["parts"]) == 3 and state["state"] == "partial" and not (tmp_path / "run/_work").exists()
    pages |= {at.format(1, 13): named(1, "13"), at.format(2, 21): named(2, "21")}
    asked.clear()
    found = run_catalogue(spark, inventory, source, policy, folder, identity, lambda: "2026-01-02T00:00:00Z")
    assert (found["status"], found["variant_count"], found["failure_attempt_count"], found["product_count"]) == ("complete", 5, 2, 3)
    assert asked == [[at.format(1, 11), at.format(2, 21)], [at.format(1, 13)]]
    assert sorted(r.sku_id for r in RunFolder(spark, folder).table("variants").collect()) == ["11", "12", "13", "21", "31"]


def test_command_line_of_one_off_runs_and_live_pages(spark, tmp_path, monkeypatch):
    from test_pages import BASE, page, product

    start = "https://www.shop.example/shop/Face Lips"
    site = {start: f'<a href="{BASE}">a</a><a href="?page=2">load more</a>', "https://www.shop.example/shop/Face Lips?page=2": f'<a href="{BASE}">a</a><a href="?page=3">load more</a>', BASE: page(product())}
    monkeypatch.setattr(http.Client, "page", lambda self, url: (site[url].encode(), "text/html; charset=utf-8"))
    (tmp_path / "s.toml").write_text("[scraper]\nrequest_delay_seconds = 0\n")
    args = ["catalogue", "--settings", f"{tmp_path}/s.toml", "--collections", f"{tmp_path}/s.toml", "--host", "www.shop.example", "--url", start]
    assert cli.main([*args, "--output", f"{tmp_path}/run"], spark) == 0
    manifest = json.loads((tmp_path / "run/run_manifest.json").read_text())
    assert (manifest["status"], manifest["collection"], manifest["variant_count"], manifest["source_type"]) == ("complete", "face-lips", 1, "listing") and manifest["finished_at"] >= manifest["started_at"]
    assert cli.main([*args, "--resume-run", f"{tmp_path}/run"], spark) == 0 and cli.main([*args, "--resume-run", f"{tmp_path}/none"], spark) == 2
    assert cli.main([*args, "--name", "other", "--resume-run", f"{tmp_path}/run"], spark) == 2 and cli.main([*args[:-2], "--name", "x", "--output", "y"], spark) == 2
    assert cli.main([*args, "--name", "d", "--discover-only", "--output", f"{tmp_path}/d"], spark) == 0
    assert json.loads((tmp_path / "d/run_manifest.json").read_text())["unresolved_product_count"] == 1
    assert http.decoded("é".encode("latin-1"), "text/html; charset=latin-1") == "é"
    with pytest.raises(UnicodeError, match="tried utf-8, ascii"):
        http.decoded(b"\xff", "text/html; charset=ascii")


def test_colour_command_line_resumes(spark, tmp_path):
    folder = tmp_path / "img"
    folder.mkdir()
    for i in (3, 1):
        (folder / f"s{i}.png").write_bytes(png(4, 4, lambda x, y, i=i: (i, 20, 30, 255)))
    rows = [("p", f"k{i}", f"{MEDIA}s{i}") for i in (3, 1, 2)]
    sinks.write_csv_file(spark.createDataFrame(rows, "product_id string, sku_id string, swatch_image_url string").coalesce(1), tmp_path / "in.csv", ["product_id", "sku_id", "swatch_image_url"])
    args = ["colors", "--input", f"{tmp_path}/in.csv", "--images", str(folder), "--output", f"{tmp_path}/out", "--media-host", "media.shop.example", "--checkpoint-interval", "2"]
    assert cli.main([*args, "--limit", "1"], spark) == 0
    assert [r.sku_id for r in files.csv_rows(spark, f"{tmp_path}/out/swatch_colors.csv").collect()] == ["k3"]
    assert cli.main(args, spark) == 1
    found = json.loads((tmp_path / "out/color_manifest.json").read_text())
    assert {k: found[k] for k in ("status", "input_row_count", "completed_row_count", "unresolved_row_count", "attempted_this_run", "succeeded_this_run", "failed_this_run", "failure_attempt_count")} == {
        "status": "partial", "input_row_count": 3, "completed_row_count": 2, "unresolved_row_count": 1, "attempted_this_run": 2, "succeeded_this_run": 1, "failed_this_run": 1, "failure_attempt_count": 1,
    }
    (folder / "s2.png").write_bytes(png(4, 4, lambda x, y: (9, 9, 9, 255)))
    assert cli.main(args, spark) == 0 and cli.main([*args, "--no-resume"], spark) == 2 and cli.main([*args, "--limit", "1"], spark) == 2
    assert [(r.sku_id, r.rgb_r) for r in files.csv_rows(spark, f"{tmp_path}/out/swatch_colors.csv").collect()] == [("k3", "3"), ("k1", "1"), ("k2", "9")]
    assert json.loads((tmp_path / "out/color_manifest.json").read_text())["failure_attempt_count"] == 1
