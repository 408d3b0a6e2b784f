import itertools
import math

import pytest
from pyspark.sql import functions as F

from tintloom.functions import color, text, urls

POLICY = urls.HostPolicy()


def one(spark, expression, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")])
    return frame.select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("value", "expected"),
    [("$1,234.50", 1234.5), (" 7 ", 7.0), ("", None), (None, None), ("1.5d", None), ("0x1", None), ("1e3", 1000.0), ("-.5", -0.5), ("1_000", 1000.0), ("abc", None), ("infinity", math.inf)],
)
def test_number(spark, value, expected):
    assert one(spark, text.number(F.col("v").cast("string")), v=value) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("  a\u00a0\u2003", "a"), ("e\u0301", "é"), (" \t\n", None), (None, None), ("Lancôme", "Lancôme")],
)
def test_optional_text(spark, value, expected):
    assert one(spark, text.optional_text(F.col("v").cast("string")), v=value) == expected


@pytest.mark.parametrize(
    ("pricing", "offer", "expected"),
    [
        ("Sale Price $10.50 Regularly $20", "9", (20.0, 10.5)), ("SALE  price 8", "9", (9.0, 8.0)), ("List price $5", "9", (9.0, None)),
        ("sale price $1,200.00", None, (None, 1.0)), (None, "$1,000", (1000.0, None)),
    ],
)
def test_prices(spark, pricing, offer, expected):
    assert tuple(one(spark, text.prices(F.col("p").cast("string"), F.col("o").cast("string")), p=pricing, o=offer)) == expected


def test_labels_and_types(spark):
    assert one(spark, text.size_text(F.lit("Size: 0.12 (x2) oz"))) == "0.12 (x2) oz"
    assert one(spark, text.size_text(F.lit("Color: Light"))) == "Color: Light"
    assert one(spark, text.variant_type(F.array(F.lit("Pick"), F.lit("Your SHADE")), F.lit(False))) == "color"
    assert one(spark, text.variant_type(F.array(F.lit("x")), F.lit(False))) == "default"
    assert one(spark, text.product_name(F.lit("Glow - RED"), F.lit("Red"), F.lit(None).cast("string"), F.lit("B"))) == "Glow"
    assert one(spark, text.product_name(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("ACME Blush"), F.lit("Acme"))) == "Blush"
    assert one(spark, text.ingredient_text(F.lit("Ingredients: water"))) == "water"
    assert one(spark, text.unescaped_brackets(F.lit("\\[+/-\\]"))) == "[+/-]"
    assert one(spark, text.price_text(F.lit("x"))) == "Not available"
    assert one(spark, text.price_text(F.lit("1234.5"))) == "$1,234.50"
    assert one(spark, text.size_label(F.lit(None).cast("double"), F.lit(" "))) == "Not available"
    assert one(spark, text.size_label(F.lit("1 "), F.lit(" g"))) == "1 g"


def test_required_number_names_the_row(spark):
    with pytest.raises(Exception, match="lab_l is missing or invalid for sku7"):
        one(spark, text.required_number(F.lit("x"), "lab_l", F.lit("sku7")))


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("/p/a-prod1?x=1&sku=5&sku=6#f", "https://www.shop.example/p/a-prod1?sku=5"), ("//shop.example/p/b", "https://www.shop.example/p/b"), ("http://SHOP.example/x?sku=", "https://www.shop.example/x"),
        ("https://other.example/p/a", None), ("mailto:a@shop.example", None), ("c?sku=a%20b", "https://www.shop.example/shop/c?sku=a+b"),
    ],
)
def test_normalized(spark, url, expected):
    assert one(spark, urls.normalized(F.lit(url), F.lit("https://www.shop.example/shop/list?page=2"), POLICY)) == expected


def test_tokens_and_names(spark):
    assert one(spark, urls.product_token(F.lit("https://x.example/p/a-xlsImpprod12-prod3?sku=prod9"))) == "xlsImpprod12"
    assert one(spark, urls.collection_name(F.lit("https://x.example/shop/Face & Lips/"))) == "face-lips"
    assert one(spark, urls.collection_name(F.lit("https://x.example/shop/_face-lips_2;v=1"))) == "face-lips_2"
    assert one(spark, urls.with_variant(F.lit("https://x.example/p"), F.lit("5"), POLICY)) == "https://x.example/p?sku=5"
    assert one(spark, urls.is_swatch_url(F.lit("http://media.shop.example/a"), POLICY)) is False


def _lab(r, g, b):
    lin = [v / 12.92 if (v := c / 255) <= 0.04045 else ((v + 0.055) / 1.055) ** 2.4 for c in (r, g, b)]
    f = []
    for row, w in zip(color.XYZ, color.WHITE, strict=True):
        t = sum(x * m for x, m in zip(lin, row, strict=True)) / w
        f.append(t ** (1 / 3) if t > (6 / 29) ** 3 else t / (3 * (6 / 29) ** 2) + 4 / 29)
    return round(116 * f[1] - 16, 2), round(500 * (f[0] - f[1]), 2), round(200 * (f[1] - f[2]), 2)


def test_lab_and_hue_on_a_grid(spark):
    grid = list(itertools.product(range(0, 256, 17), repeat=3))
    frame = spark.createDataFrame(grid, "r int, g int, b int").withColumn("lab", color.lab_rounded(F.col("r"), F.col("g"), F.col("b")))
    for row in frame.withColumn("hue", color.hue(F.col("lab.lab_a"), F.col("lab.lab_b"))).collect():
        lightness, a, b = _lab(row.r, row.g, row.b)
        assert tuple(row.lab) == (lightness, a, b)
        assert row.hue == pytest.approx(math.degrees(math.atan2(b, a)), abs=1e-9)


@pytest.mark.parametrize(("size", "fraction", "expected"), [(1, 0.2, (1, 0)), (5, 0.5, (2, 1)), (7, 0.5, (4, 1)), (100, 0.2, (20, 40)), (3, 1.0, (3, 0))])
def test_crop(spark, size, fraction, expected):
    assert tuple(one(spark, color.crop(F.lit(size), fraction))) == expected
