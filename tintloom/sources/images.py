"""Swatch images: decoding by Spark's image source, crops and pixels as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintloom.functions.color import crop
from tintloom.operators import pixels

#: Method tag of a measurement, and the most bytes an image may have.
METHOD, MOST_BYTES, CROP = "center_crop_median_v1", 10_000_000, 0.20


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, image_sha256, image): files of at most MOST_BYTES with their digest and decoded raster; unreadable ones have height -1.

    Spark decodes what Java's ImageIO reads; orientation tags aren't applied.
    """
    decoded = spark.read.format("image").load(path).select(F.regexp_replace("image.origin", "^file:/+", "/").alias("path"), "image")
    hashed = spark.read.format("binaryFile").load(path).where(F.col("length") <= MOST_BYTES).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.sha2("content", 256).alias("image_sha256"))
    return hashed.join(decoded, "path")


def crop_pixels(images: DataFrame, keys: tuple[str, ...] = ("path",), fraction: float = CROP) -> DataFrame:
    """(keys, r, g, b, a) of the pixels in the centred crop of each readable image."""
    if not 0 < fraction <= 1:
        raise ValueError("the crop is a share of the image")
    good = images.where("image.height > 0 and image.width > 0").select(*keys, "image", crop(F.col("image.width"), fraction).alias("cw"), crop(F.col("image.height"), fraction).alias("ch"))
    n = F.col("image.nChannels")

    def pixel(i):
        x, y = F.col("cw.offset") + i % F.col("cw.side"), F.col("ch.offset") + F.floor(i / F.col("cw.side")).cast("int")
        at = (y * F.col("image.width") + x) * n + 1
        byte = lambda c: F.conv(F.hex(F.substring("image.data", at + c, F.lit(1))), 16, 10).cast("int")
        # Channels are blue, green, red, and alpha if there are four; one channel is grey.
        return F.struct(
            F.when(n >= 3, byte(2)).otherwise(byte(0)).alias("r"), F.when(n >= 3, byte(1)).otherwise(byte(0)).alias("g"), byte(0).alias("b"), F.when(n == 4, byte(3)).otherwise(F.lit(255)).alias("a")
        )

    places = F.sequence(F.lit(0), F.col("cw.side") * F.col("ch.side") - 1)
    return good.select(*keys, F.inline(F.transform(places, pixel)))


def measure_images(images: DataFrame, fraction: float = CROP, white: int = pixels.WHITE, foreground: float = pixels.FOREGROUND) -> DataFrame:
    """The 13 fields of each image's colour, or `error`: not readable, or nothing visible in the crop."""
    measured = pixels.measure(crop_pixels(images, ("path",), fraction), ["path"], white, foreground)
    joined = images.join(measured, "path", "left")
    error = F.when(F.col("image.height") < 1, "not a readable image").when(F.col("sample_pixel_count").isNull(), "the crop has no visible pixels")
    return joined.select(
        "path", "image_sha256", F.col("image.width").alias("image_width"), F.col("image.height").alias("image_height"), "sample_pixel_count", "rgb_r", "rgb_g", "rgb_b", "hex_color", "lab_l", "lab_a", "lab_b", "rgb_spread",
        F.lit(METHOD).alias("extraction_method"), error.alias("error"),
    )


def file_sha256(spark: SparkSession, path: str) -> str:
    """Digest of one file, read by an executor."""
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]
