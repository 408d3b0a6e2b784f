"""A catalogue run over pages and a colour run over images: what each attempt gave, and the tables that follow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tintloom.functions import urls
from tintloom.functions.urls import HostPolicy
from tintloom.operators import snapshot
from tintloom.operators.product_pages import listing_products, next_pages, product_rows, raw_pages
from tintloom.sources.images import measure_images

#: Where pages come from: addresses (url) to rows url, html, error_type, message, the last two for pages that couldn't be had.
PageSource = Callable[[DataFrame], DataFrame]
#: Keeps a frame that several others are made of, under a name.
Store = Callable[[DataFrame, str], DataFrame]


def stored_pages(pages: DataFrame) -> PageSource:
    """Pages of a table (url, html, and error_type and message if there): of several with one address that whose html sorts first."""
    log = [c if c in pages.columns else F.lit(None).cast("string").alias(c) for c in ("error_type", "message")]
    once = snapshot.keep_first(pages.select("url", "html", *log).withColumn("__none", F.isnull("html")), ["url"], ["__none", "html"]).drop("__none")

    def source(addresses: DataFrame) -> DataFrame:
        found = addresses.select("url").distinct().join(snapshot.beside(once), "url", "left")
        missing = F.col("html").isNull()
        return found.select(
            "url", "html", F.when(missing, F.coalesce("error_type", F.lit("LookupError"))).alias("error_type"), F.when(missing, F.coalesce("message", F.lit("page not found"))).alias("message")
        )

    return source


def discover(pages: DataFrame, start: str, policy: HostPolicy, max_pages: int = 100) -> DataFrame:
    """(product_id, product_url, listing_page, listing_position) of the products on a listing's chain of pages (url, html).

    Every page's links are read once; then only the pages of the chain, at most max_pages, are read for products.
    """
    spark = pages.sparkSession
    once = pages.dropDuplicates(["url"])
    listed = lambda p: listing_products(raw_pages(p, parts="listing"), policy)
    edges = next_pages(raw_pages(once, parts="links")).persist()
    reached = snapshot.pagination(edges, start, max_pages).collect()
    edges.unpersist()
    chain = spark.createDataFrame(reached, "url string, page_no int")
    products = listed(once.join(F.broadcast(chain.select("url")), "url", "left_semi"))
    ids = products.groupBy("url").agg(F.collect_list("product_id").alias("product_ids"))
    following = chain.withColumn("at", F.col("page_no") + 1).join(chain.select(F.col("url").alias("next"), F.col("page_no").alias("at")), "at", "left")
    known = following.select("url", "next").join(ids, "url", "left").withColumn("product_ids", F.coalesce("product_ids", F.array().cast("array<string>")))
    last = snapshot.pagination(known, start, max_pages)
    found = last.join(products, "url").select("product_id", "product_url", F.col("url").alias("listing_page"), "page_no", "ord", F.lower("product_id").alias("k"))
    return snapshot.positions(snapshot.keep_first(found, ["k"], ["page_no", "ord"]), ["page_no", "ord"], "listing_position").select("product_id", "product_url", "listing_page", "listing_position")


def discover_live(spark: SparkSession, source: PageSource, start: str, policy: HostPolicy, max_pages: int = 100) -> DataFrame:
    """What `discover` gives, from a source: each listing page is had only when the one before it names it and has brought a new product."""
    url, seen, products, rows = start, set(), set(), []
    while url and url not in seen and len(seen) < max_pages:
        seen.add(url)
        page = source(spark.createDataFrame([(url,)], "url string")).first()
        if page["html"] is None:
            raise ValueError(f"{url}: {page['error_type']}: {page['message']}")
        raw = raw_pages(spark.createDataFrame([(url, page["html"])], "url string, html string"), parts="listing")
        fresh = [r for r in sorted(listing_products(raw, policy).collect(), key=lambda r: r["ord"]) if r["product_id"].lower() not in products]
        products |= {r["product_id"].lower() for r in fresh}
        rows += [(r["product_id"], r["product_url"], url) for r in fresh]
        url = next_pages(raw).first()["next"] if fresh else None
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows, 1)], "product_id string, product_url string, listing_page string, listing_position long")


def read_products(source: PageSource, addresses: DataFrame, policy: HostPolicy) -> DataFrame:
    """(url, product, variant, ingredient, variant_urls, error_type, message) of every address (url)."""
    fetched = source(addresses)
    parsed = product_rows(raw_pages(fetched.where("html is not null"), parts="product"), policy)
    good = parsed.select("url", "product", "variant", "ingredient", "variant_urls", "error_type", F.col("error").alias("message"))
    lost = fetched.where("html is null").select("url", *[F.lit(None).cast(parsed.schema[c].dataType).alias(c) for c in ("product", "variant", "ingredient", "variant_urls")], "error_type", "message")
    return good.unionByName(lost)


def attempts(inventory: DataFrame, source: PageSource, policy: HostPolicy, known_skus: DataFrame | None = None, store: Store = lambda f, _: f) -> DataFrame:
    """What every page of a run gave: (listing_position, at, product_id, url, stage, product, variant, ingredient, error_type, message).

    A product's own page comes first (at = -1), then those of its variants in their order. A variant isn't read if
    its SKU is known: from `known_skus` (sku_id), from a product's own page up to its own, or from the page of an
    address before it. So a second address of a SKU is read only where the first one failed.
    """
    kinds = ["product", "variant", "ingredient", "error_type", "message"]
    wanted = inventory.select("listing_position", F.coalesce("product_id", "product_url").alias("product_id"), F.col("product_url").alias("url"))
    own = store(wanted.join(snapshot.beside(read_products(source, wanted, policy)), "url"), "own")
    more = own.select("listing_position", "product_id", F.posexplode("variant_urls").alias("at", "url")).withColumn("sku_id", urls.parameter(F.col("url"), policy.parameter))
    seen = own.where("variant is not null").groupBy(F.col("variant.sku_id").alias("sku_id")).agg(F.min("listing_position").alias("since"))
    if known_skus is not None:
        seen = seen.unionByName(known_skus.select("sku_id", F.lit(0).cast(seen.schema["since"].dataType).alias("since"))).groupBy("sku_id").agg(F.min("since").alias("since"))
    open_ = more.join(snapshot.beside(seen), "sku_id", "left").where("since is null or since > listing_position").drop("since")
    tried = store(open_.join(snapshot.beside(read_products(source, open_, policy)), "url"), "variants")
    first = tried.where("variant.sku_id = sku_id").groupBy("sku_id").agg(F.min(F.struct("listing_position", "at")).alias("first"))
    read = tried.join(snapshot.beside(first), "sku_id", "left").where(F.col("first").isNull() | (F.struct("listing_position", "at") <= F.col("first")))
    rows = own.select("listing_position", F.lit(-1).alias("at"), "product_id", "url", F.lit("product").alias("stage"), *kinds)
    return rows.unionByName(read.select("listing_position", "at", "product_id", "url", F.lit("variant").alias("stage"), *kinds))


def tables_of(rows: DataFrame, occurred_at: Column) -> dict[str, DataFrame]:
    """products, variants, ingredients, failures and completed that follow from attempts.

    Of rows with one key the first in order stays. A product is completed if its own page and all its variants
    that were tried could be read.
    """
    order = ["listing_position", "at"]
    table = lambda c, key: snapshot.keep_first(rows.where(F.col(c).isNotNull()).select(*order, f"{c}.*"), [key], order).drop(*order)
    failures = snapshot.failures_of(rows, F.col("stage"), occurred_at)
    completed = rows.groupBy("product_id").agg(F.count("error_type").alias("failed")).where("failed = 0").select("product_id")
    return {"products": table("product", "product_id"), "variants": table("variant", "sku_id"), "ingredients": table("ingredient", "ingredient_set_id"), "failures": failures, "completed": completed}


def catalogue_tables(inventory: DataFrame, pages: DataFrame, policy: HostPolicy, occurred_at: Column, saved: dict[str, DataFrame] | None = None, store: Store = lambda f, _: f) -> dict[str, DataFrame]:
    """products, variants, ingredients, failures and completed of the inventory's products, from pages (url, html).

    With the tables of a run before, its completed products aren't tried again, its rows stay, and failures are
    added to its log.
    """
    todo = inventory if saved is None else todo_of(inventory, saved["completed"])
    found = tables_of(store(attempts(todo, stored_pages(pages), policy, saved and saved["variants"], store), "attempts"), occurred_at)
    return found if saved is None else {name: merged(name, saved[name], frame) for name, frame in found.items()}


#: What tells the rows of a run's tables apart; of failures every attempt counts.
KEYS = {"products": "product_id", "variants": "sku_id", "ingredients": "ingredient_set_id", "completed": "product_id"}


def todo_of(inventory: DataFrame, completed: DataFrame) -> DataFrame:
    """What of an inventory isn't completed; a product without an id goes by its address."""
    named = inventory.withColumn("__id", F.coalesce("product_id", "product_url"))
    return snapshot.unresolved(named, completed.select(F.col("product_id").alias("__id")), "__id").drop("__id")


def merged(name: str, saved: DataFrame, new: DataFrame) -> DataFrame:
    """Saved rows of a table and the new ones that aren't there yet."""
    return snapshot.resume_union(saved, new, [KEYS[name]]) if name in KEYS else saved.unionByName(new)


def color_run(swatches: DataFrame, images: DataFrame, saved: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(colours, failures) of swatches (product_id, sku_id, swatch_image_url) from images (swatch_image_url, path, ...).

    Saved colours stay and aren't measured again; saved keys that the selection lacks are an error.
    """
    keys = ["sku_id", "swatch_image_url"]
    todo = swatches
    if saved is not None:
        if stale := snapshot.stale_keys(saved, swatches, keys).first():
            raise snapshot.ContractError(f"saved colours have keys that the input lacks: {stale.asDict()}")
        todo = swatches.join(saved.select(*keys), keys, "left_anti")
    wanted = todo.join(images, "swatch_image_url", "left")
    measured = measure_images(images.join(todo.select("swatch_image_url").distinct(), "swatch_image_url", "left_semi").select("path", "image_sha256", "image"))
    rows = wanted.select("product_id", *keys, "path").join(measured, "path", "left")
    good = rows.where("path is not null and error is null").drop("path", "error")
    kind = F.when(F.col("path").isNull(), "LookupError").when(F.col("error") == "not a readable image", "UnidentifiedImageError").otherwise("ValueError")
    bad = rows.where("path is null or error is not null").select("product_id", *keys, kind.alias("error_type"), F.coalesce("error", F.lit("no image")).alias("message"))
    return (good if saved is None else saved.unionByName(good)), bad


def attempt_counts(selected: DataFrame, saved: DataFrame | None, colors: DataFrame, failures: DataFrame, log: DataFrame) -> DataFrame:
    """One row of a colour run's counters, from its selection, the colours before and after it, its failures and the whole log."""
    count = lambda f, n: f.agg(F.count(F.lit(1)).alias(n))
    row = count(selected, "input_row_count")
    for part in (count(colors, "completed_row_count"), count(failures, "failed_this_run"), count(log, "failure_attempt_count"), count(colors if saved is None else saved, "before")):
        row = row.crossJoin(part)  # of single rows
    done = F.col("completed_row_count") - (F.lit(0) if saved is None else F.col("before"))
    return row.select(
        snapshot.run_status(F.col("completed_row_count"), F.col("input_row_count")).alias("status"), "input_row_count", "completed_row_count", (F.col("input_row_count") - F.col("completed_row_count")).alias("unresolved_row_count"),
        (done + F.col("failed_this_run")).alias("attempted_this_run"), done.alias("succeeded_this_run"), "failed_this_run", "failure_attempt_count",
    )
