import json

import pytest
from pyspark.sql import functions as F

from tintloom.functions.urls import HostPolicy
from tintloom.operators import dom, runs
from tintloom.operators import product_pages as P

POLICY = HostPolicy()
BASE = "https://www.shop.example/p/glow-prod1?sku=11"


def product(sku="11", **more):
    return {"@type": "Product", "productID": "prod1", "sku": sku, "name": "Glow - Rosé", "color": "Rosé", "brand": {"name": "Lancôme"}, "offers": {"price": "30.00", "availability": "https://s.example/InStock"}} | more


def page(data, body="", script=""):
    return f'<html><head><script type="application/ld+json">{{bad</script><script type="application/ld+json">{json.dumps(data)}</script>{script}</head><body>{body}</body></html>'


def parsed(spark, *pages):
    frame = spark.createDataFrame(list(pages), "url string, html string")
    return [r.asDict(recursive=True) for r in P.product_rows(P.raw_pages(frame), POLICY).collect()]


@pytest.mark.parametrize(
    ("selector", "expected"),
    [("a", 3), (".x a", 2), (".x .y a[href*='/p/']", 1), ("a[href]", 2), ("[data-k='v']", 1), ("div.x.z, li", 2), ("[class*=z] a", 2), ("ul > a".replace(">", ""), 1)],
)
def test_selectors(selector, expected):
    root = dom.parse("<div class='x z'><ul class=y><li data-k=v><a href='/p/1'>1</a></ul><a href='#'>2</a></div><a>3</a>")
    assert len(list(dom.Selector(selector).all(root))) == expected


def test_text_leaves_out_scripts_and_decodes():
    root = dom.parse("<p> a <b>b&amp;c</b><script>x()</script><br>d<!-- no --> </p>")
    assert root.text() == "a b&c d"


def _shape(node):
    return (node.tag, node.attrs, node.number, node.classes, [c if isinstance(c, str) else _shape(c) for c in node.children])


PIECES = (
    "<p>", "</p>", "<div class='a b a'>", "</div>", '<a href="/p/x?a=1&amp;b=2&copy=3" data-k=v>', "</A >", "<br>", "<br/>", "<img src=/i/1.png>", "<img src='x' / alt=y/>", "<i a=b/>", "<LI Class=x disabled>", "text &amp; more", "&", "&#65", " <", "<!-- c -->", "<!---->", "<!-- a > b -->",
    "<!--->", "<!DOCTYPE html>", "<?pi?>", "<script>a && b &amp; {}</script>", "<script>if (a<b) '</p>'</script>", "<SCRIPT type='application/ld+json'></script >", "<style>p>a{}</style>", "<title>a &lt; b</title>", "<textarea>x</textarea>", "<svg/>", "<a a='1'b=2>", "<x-y>", "</x-y>", "</ p>", "</>", "<p\x0bq>",
    "<a =b>", "<a b = 'c'>", "<a b=\"x\ny\" B=2>", "\0", "<script>", "é\u2028", "<![CDATA[x]]>", "<script/>", "<a b='>'>", "<b", "'", '"',
)


def test_plain_pages_have_the_tree_of_the_standard_parser():
    import random

    draw, plain = random.Random(1), 0
    for n in range(6000):
        text = "".join(draw.choices(PIECES[:12] + PIECES[22:23] if n % 2 else PIECES, k=draw.randint(0, 12)))
        tree = dom._plain(text)
        plain += tree is not None
        assert tree is None or _shape(tree) == _shape(dom._parsed(text)), text
        assert _shape(dom.parse(text)) == _shape(dom._parsed(text)), text
    assert plain > 1000


def test_plain_addresses_are_joined_as_the_standard_library_does():
    from urllib.parse import urljoin

    base = "https://www.shop.example/p/a-prod1?sku=1"
    for address in ("/p/x", "/", "//else.example/x", "/p//x", "/p/./x", "/p/../x", "/p/x.png", "/p/x?", "/p/x?sku=1&b=%20", "/p/x#", "/p/x#a", "?page=2", "x", "", "/p/.x", "/p/x;y", "/a:b", "/p/x/", "/p/x..y", "/p/..", "/é", "https://else.example", "/ x", "/p/x\n", "/p/a?b=/../c"):
        found = P.raw_page(f"<a href='{address}'>a</a>", base, frozenset(["links"]))["links"][0]["href"]
        assert found == urljoin(base, address), address


def test_product_page(spark):
    body = """<main><h1>x</h1></main><div class="ProductPricing">Sale Price $20.50 Regularly $30</div><div class="ProductDimension">Size: 5 oz</div>
    <div class="ProductSwatches ProductSwatches--content"><a href="/p/glow-prod1?sku=11&x=1"><img src="/i/11.png" alt="Rosé Glow"></a><a href="/p/glow-prod1?sku=12">b</a><a href="https://else.example/p?sku=1">c</a></div>
    <section><h3>Ingredients</h3><p>Aqua, Città</p></section>"""
    row = parsed(spark, (BASE, page([{"@type": "Other"}, {"@graph": [product()]}], body)))[0]
    assert row["error"] is None
    assert row["product"]["product_name"] == "Glow" and row["product"]["brand"] == "Lancôme" and row["product"]["product_url"] == "https://www.shop.example/p/glow-prod1"
    v = row["variant"]
    assert (v["list_price"], v["sale_price"], v["size_text"], v["availability"], v["variant_name"], v["variant_type"]) == (30.0, 20.5, "5 oz", "InStock", "Rosé", "color")
    assert v["swatch_image_url"] == "https://www.shop.example/i/11.png"
    assert row["variant_urls"] == ["https://www.shop.example/p/glow-prod1?sku=11", "https://www.shop.example/p/glow-prod1?sku=12"]
    assert row["ingredient"]["ingredients"] == "Aqua, Città" and len(v["ingredient_set_id"]) == 64


@pytest.mark.parametrize(
    ("data", "error"),
    [({"@type": ["Product"]}, "product data not found"), (product(productID=None), None), (product(sku=None), None)],
)
def test_missing_parts(spark, data, error):
    row = parsed(spark, (BASE, page(data)))[0]
    assert row["error"] == error
    if error is None:
        assert row["product"]["product_id"] == "prod1" and row["variant"]["sku_id"] == "11"


def test_no_ids(spark):
    rows = parsed(spark, ("https://www.shop.example/p/glow?sku=1", page(product(productID=" "))), ("https://www.shop.example/p/glow-prod1", page(product(sku=""))))
    assert {r["error"] for r in rows} == {"product id not found", "sku not found"}


@pytest.mark.parametrize("offers", ["text", [], None, [{"price": "5"}]])
def test_offers_of_any_shape(spark, offers):
    row = parsed(spark, (BASE, page(product(offers=offers))))[0]
    assert row["error"] is None and row["variant"]["list_price"] == (5.0 if offers and offers != "text" else None)


@pytest.mark.parametrize(
    ("state", "expected"),
    [
        ('{"a":{"ingredients":"Aqua \\\\[x\\\\]"}} ; more()', "Aqua [x]"), ('{"a":[{"ingredients":["no"]},{"b":{"ingredients":"Oil"}}]}', "Oil"), ('{"ingredients":"  ","b":{"ingredients":"Wax"}}', "Wax"), ("{broken", None),
    ],
)
def test_state_ingredients(spark, state, expected):
    row = parsed(spark, (BASE, page(product(), script=f"<script>window.__APOLLO_STATE__ = {state}</script>")))[0]
    assert (row["ingredient"] or {}).get("ingredients") == expected


@pytest.mark.parametrize(
    "body",
    [
        "<div data-test='ingredients'>Ingredients: Wax</div>", "<div data-testid='ingredients'>Wax</div>", "<p class=ProductDetail__ingredients>ingredient: Wax</p>", "<li><button>Ingredients:</button> <p>Wax</p></li>",
        "<div><div><h2>Ingredients</h2></div> <p>Wax</p></div>",
    ],
)
def test_dom_ingredients(spark, body):
    row = parsed(spark, (BASE, page(product(), body)))[0]
    assert row["ingredient"]["ingredients"] == "Wax"


LISTING = """<div class="ProductCard"><a class="pal-c-Link--absolute" href="/p/a-prod1?sku=1">a</a></div><div class="ProductCard"><a class="pal-c-Link--absolute" href="/p/b-PROD1">b</a></div>
<div class="ProductCard"><a class="pal-c-Link--absolute" href="https://else.example/p/c-prod3">c</a></div><a href="/p/d-prod4">d</a><a href="{next}">Load <b>more</b></a>"""


def test_discovery(spark):
    start = "https://www.shop.example/shop/face"
    pages = spark.createDataFrame([(start, LISTING.format(next="?page=2")), (f"{start}?page=2", '<a href="/p/e-vp5">e</a><a href="/p/f-prod1">f</a><a href="?page=1&x">load more</a>')], "url string, html string")
    found = runs.discover(pages, start, POLICY).orderBy("listing_position").collect()
    assert [(r.product_id, r.listing_position) for r in found] == [("prod1", 1), ("vp5", 2)]
    assert found[0].product_url == "https://www.shop.example/p/a-prod1?sku=1"


def test_catalogue_tables(spark):
    second = "https://www.shop.example/p/glow-prod1?sku=12"
    swatches = f'<div class="ProductSwatches--content"><a href="{second}">b</a><a href="/p/glow-prod1?sku=13">c</a></div>'
    pages = spark.createDataFrame([(BASE, page(product(), swatches)), (second, page(product("12", color="Blue"))), ("https://www.shop.example/p/x-prod2", "<p>broken</p>")], "url string, html string")
    inventory = spark.createDataFrame([("prod1", BASE, 1), ("prod2", "https://www.shop.example/p/x-prod2", 2)], "product_id string, product_url string, listing_position int")
    tables = runs.catalogue_tables(inventory, pages, POLICY, F.lit("2026-01-01T00:00:00Z"))
    assert {r.sku_id for r in tables["variants"].collect()} == {"11", "12"}
    # A product whose variant failed isn't completed.
    assert tables["products"].count() == 1 and tables["completed"].count() == 0
    assert {(r.error_type, r.message) for r in tables["failures"].collect()} == {("LookupError", "page not found"), ("ParseError", "product data not found")}
    assert {(r.stage, r.product_id) for r in tables["failures"].collect()} == {("product", "prod2"), ("variant", "prod1")}


def test_runs_send_no_side_of_a_join_to_the_driver(spark):
    """Whatever Spark estimates of pages and keys, which grow with the input; of a run and of one that goes on."""
    from conftest import SF

    from tintloom.plans import run_queries

    def plain(frame):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
        return frame

    def store():
        keep = run_queries.keeper(spark)
        return lambda frame, name: keep(plain(frame), name)

    keep = store()
    first = {name: keep(frame, name) for name, frame in runs.catalogue_tables(*run_queries.part_run(spark, SF), POLICY, F.lit("t"), store=store()).items()}
    again = runs.catalogue_tables(*run_queries.part_run(spark, SF, repaired=True), POLICY, F.lit("u"), first, store())
    for frame in again.values():
        plain(frame)
