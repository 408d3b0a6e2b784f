"""Command lines: catalogue runs, colour runs, the colour map."""

from __future__ import annotations

import argparse
import re
import sys
import tempfile
from collections.abc import Sequence
from dataclasses import asdict
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintloom import config
from tintloom.functions import urls
from tintloom.functions.urls import HostPolicy
from tintloom.operators import runs, snapshot
from tintloom.plans.catalogue_run import run_catalogue
from tintloom.plans.colour_map import COLOR_COLUMNS, VARIANT_COLUMNS, map_points, write_map_page
from tintloom.session import build_session
from tintloom.sources import files, http, images, sinks

SCHEMA_VERSION = 1


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tintloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    crawl = commands.add_parser("catalogue", help="tables of a collection")
    crawl.add_argument("collection", nargs="?")
    for flag, text in (("--settings", "TOML with the settings"), ("--collections", "TOML with the collections")):
        crawl.add_argument(flag, required=True, help=text)
    crawl.add_argument("--pages", help="Parquet of url and html; without it pages are fetched")
    crawl.add_argument("--output", help="folder of the run")
    crawl.add_argument("--resume-run", help="folder of a run to go on with, instead of --output")
    crawl.add_argument("--host", action="append", required=True, help="allowed host; the last is the canonical one")
    crawl.add_argument("--url", help="a listing or product instead of the collection's, for a run of its own")
    crawl.add_argument("--name", help="name of a run with --url; else taken from the address")
    crawl.add_argument("--product-url", action="append", default=[], help="a product instead of the collection's listing; can be repeated")
    crawl.add_argument("--max-products", type=int)
    crawl.add_argument("--checkpoint-interval", type=int, help="products of a batch; for fetched pages that of the settings, else all at once")
    crawl.add_argument("--discover-only", action="store_true")
    crawl.add_argument("--list", action="store_true", help="print the collections and end")
    colors = commands.add_parser("colors", help="colours of swatch images")
    for flag in ("--input", "--images", "--output"):
        colors.add_argument(flag, required=True)
    colors.add_argument("--media-host", required=True)
    colors.add_argument("--failures", help="file of the failure log; else in the output folder")
    colors.add_argument("--manifest", help="file of the manifest; else in the output folder")
    colors.add_argument("--limit", type=int)
    colors.add_argument("--checkpoint-interval", type=int, help="swatches after which the output is written; else at the end")
    colors.add_argument("--no-resume", action="store_true", help="refuse an output that exists")
    colors.add_argument("--crop-fraction", type=float, default=images.CROP)
    shown = commands.add_parser("map", help="the colour map's page")
    for flag in ("--variants", "--colors", "--output"):
        shown.add_argument(flag, required=True)
    return top


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _chosen(spark: SparkSession, args: argparse.Namespace) -> config.Collection:
    """The named collection, or that of --url with its own name."""
    if args.name and not args.url:
        raise ValueError("--name goes with --url only")
    if not args.url:
        return config.load_collection(args.settings, args.collections, args.collection, tuple(args.host))
    name = args.name or spark.range(1).select(urls.collection_name(F.lit(args.url))).first()[0]
    return config.Collection(name, args.url, tuple(args.host), "auto", config.load_settings(args.settings))


def _catalogue(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.list:
        print("\n".join(config.collection_names(args.collections)))
        return 0
    for value, what in ((args.max_products, "--max-products"), (args.checkpoint_interval, "--checkpoint-interval")):
        if value is not None and value < 1:
            raise ValueError(f"{what} must be at least 1")
    folder = args.resume_run or args.output
    if not folder:
        raise ValueError("--output or --resume-run is missing")
    chosen, started = _chosen(spark, args), _now()
    settings = chosen.settings
    policy = HostPolicy(hosts=tuple(args.host), canonical=args.host[-1])
    if args.resume_run and not files.exists(spark, folder):
        raise FileNotFoundError(folder)
    saved = files.json_document(spark, f"{folder}/run_manifest.json")
    identity = {
        "schema_version": SCHEMA_VERSION, "run_id": re.sub(r"[-:]", "", started), "collection": chosen.name, "source_url": chosen.source_url, "source_type": chosen.resolved_type,
        "started_at": started, "finished_at": None, "status": "running", "scraper_settings": asdict(settings),
    }
    if saved:
        sinks.check_resume(saved, identity)
        identity |= {k: saved[k] for k in ("run_id", "started_at") if k in saved}
    sinks.write_json_file(identity, f"{folder}/run_manifest.json")
    if args.pages:
        pages = spark.read.parquet(args.pages)
        source, interval = runs.stored_pages(pages), args.checkpoint_interval
        listing = lambda: runs.discover(pages, chosen.source_url, policy, settings.max_pages)
    else:
        client = http.Client(args.host, settings.user_agent, settings.request_delay_seconds, settings.timeout_seconds, settings.max_retries)
        source, interval = http.live_pages(spark, client), args.checkpoint_interval or settings.checkpoint_interval
        listing = lambda: runs.discover_live(spark, source, chosen.source_url, policy, settings.max_pages)

    def inventory():
        found = files.product_list(spark, args.product_url or [chosen.source_url], policy) if args.product_url or chosen.resolved_type == "product" else listing()
        return found if args.max_products is None else snapshot.first_n(found, args.max_products, ["listing_position"])

    if args.discover_only:
        known = sinks.RunFolder(spark, folder).save_inventory(inventory())
        n = known.count()
        counts = {"inventory_product_count": n, "product_count": 0, "variant_count": 0, "ingredient_set_count": 0, "failure_attempt_count": 0, "unresolved_product_count": n}
        sinks.write_json_file({**identity, "finished_at": _now(), "status": "discovered", **counts}, f"{folder}/run_manifest.json")
        return 0
    run_catalogue(spark, inventory, source, policy, folder, identity, _now, interval)
    return 0


def _colors(spark: SparkSession, args: argparse.Namespace) -> int:
    for value, what in ((args.limit, "--limit"), (args.checkpoint_interval, "--checkpoint-interval")):
        if value is not None and value < 1:
            raise ValueError(f"{what} must be at least 1")
    started, output = _now(), f"{args.output}/swatch_colors.csv"
    failures, manifest = args.failures or f"{args.output}/swatch_failures.csv", args.manifest or f"{args.output}/color_manifest.json"
    if args.no_resume and files.exists(spark, output):
        raise FileExistsError(output)
    policy = HostPolicy(media_host=args.media_host)
    table = files.csv_table(spark, args.input, ("sku_id", "swatch_image_url"))
    if "product_id" not in table.columns:
        table = table.withColumn("product_id", F.lit(""))
    swatches = files.swatch_input(table, policy, "row").select("product_id", "sku_id", "swatch_image_url", "row")
    if args.limit is not None:
        swatches = snapshot.first_n(swatches, args.limit, ["row"])
    found = images.image_files(spark, args.images).withColumn("name", F.regexp_extract("path", r"([^/]+?)(?:\.[A-Za-z]+)?$", 1))
    named = swatches.select("swatch_image_url", F.regexp_extract("swatch_image_url", r"([^/?]+?)(?:\?.*)?$", 1).alias("name")).distinct().join(found, "name").drop("name")
    keys = ["sku_id", "swatch_image_url"]
    log, before = files.csv_rows(spark, failures, sinks.COLOR_FAILURES), files.csv_rows(spark, output, sinks.COLORS)
    with tempfile.TemporaryDirectory() as work:
        # The files that are replaced below are read from copies.
        keep = lambda f, n: (f.write.parquet(f"file://{work}/{n}"), spark.read.parquet(f"file://{work}/{n}"))[1]
        log, before = keep(log, "log"), keep(before, "before")
        if stale := snapshot.stale_keys(before, swatches, keys).first():
            raise snapshot.ContractError(f"saved colours have keys that the input lacks: {stale.asDict()}")
        todo = keep(swatches.join(before.select(*keys), keys, "left_anti"), "todo")
        batched = sinks.batches(todo, ["row"], args.checkpoint_interval) if args.checkpoint_interval else todo.withColumn("batch", F.lit(0))
        colors, lost = before, log.limit(0)
        for batch in [r["batch"] for r in batched.select("batch").distinct().orderBy("batch").collect()]:
            good, bad = runs.color_run(batched.where(F.col("batch") == batch).drop("batch", "row"), named)
            text_of = lambda f, names: f.select(*[F.col(c).cast("string").alias(c) for c in names])
            colors = colors.unionByName(keep(text_of(good, sinks.COLORS), f"good-{batch}"))
            lost = lost.unionByName(keep(text_of(bad, sinks.COLOR_FAILURES), f"bad-{batch}"))
            _write_colors(colors, log.unionByName(lost), swatches, output, failures)
        if todo.isEmpty():
            _write_colors(colors, log, swatches, output, failures)
        counts = runs.attempt_counts(swatches, before, colors, lost, log.unionByName(lost)).first().asDict()
    result = {
        "started_at": started, "finished_at": _now(), "input_path": args.input, "input_sha256": images.file_sha256(spark, args.input), "output_path": output, "extraction_method": images.METHOD,
        "color_fields": list(sinks.COLORS), **counts,
    }
    sinks.write_json_file(result, manifest)
    return 0 if counts["status"] == "complete" else 1


def _write_colors(colors: DataFrame, log: DataFrame, swatches: DataFrame, output: str, failures: str) -> None:
    placed = lambda f: f.join(swatches.select("sku_id", "swatch_image_url", "row"), ["sku_id", "swatch_image_url"], "left").orderBy("row")
    sinks.write_csv_file(placed(colors), output, sinks.COLORS)
    sinks.write_csv_file(placed(log), failures, sinks.COLOR_FAILURES)


def _map(spark: SparkSession, args: argparse.Namespace) -> int:
    points = map_points(files.csv_table(spark, args.variants, VARIANT_COLUMNS), files.csv_table(spark, args.colors, COLOR_COLUMNS))
    write_map_page(points, args.output)
    return 0


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or build_session()
    try:
        return {"catalogue": _catalogue, "colors": _colors, "map": _map}[args.command](spark, args)
    except (ValueError, OSError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
