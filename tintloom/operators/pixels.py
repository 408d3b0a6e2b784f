"""Representative colours of pixel groups: one aggregation, no second pass over the pixels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintloom.functions.color import chroma, hex_color, hue, lab_rounded
from tintloom.functions.text import fixed

#: Pixels with less alpha are invisible; those with all channels from WHITE on are background.
ALPHA, WHITE, FOREGROUND = 15, 245, 0.05
CHANNELS = ("r", "g", "b")


def measure(pixels: DataFrame, keys: Sequence[str], white: int = WHITE, foreground: float = FOREGROUND) -> DataFrame:
    """Sample size, median colour, spread, hex and L*a*b* of each group of pixels (keys, r, g, b, a).

    The sample is the visible pixels that aren't white if there are enough of them, else all visible ones.
    Medians are exact and cut to integers. The spread is the root of the mean squared distance to the median
    colour; it follows from sums, as the sum of squares, the sum and the number determine it. A group without
    visible pixels gives no row.
    """
    if not (0 < foreground <= 1 and 0 <= white <= 255):
        raise ValueError("foreground is a share, white a channel value")
    visible = pixels.where(F.col("a") > ALPHA)
    shown = ~((F.col("r") >= white) & (F.col("g") >= white) & (F.col("b") >= white))
    parts = []
    for name, use in (("all", F.lit(True)), ("fg", shown)):
        pick = lambda c, use=use: F.when(use, c.cast("long"))
        parts += [F.count_if(use).alias(f"n_{name}"), F.sum(pick(sum(F.col(c).cast("long") * F.col(c).cast("long") for c in CHANNELS))).alias(f"q_{name}")]
        for c in CHANNELS:
            parts += [F.median(pick(F.col(c))).alias(f"m_{c}_{name}"), F.sum(pick(F.col(c))).alias(f"s_{c}_{name}")]
    sums = visible.groupBy(*keys).agg(*parts)
    enough = F.col("n_fg") >= F.greatest(F.lit(1), F.ceil(F.col("n_all") * F.lit(foreground)))
    of = lambda n: F.when(enough, F.col(f"{n}_fg")).otherwise(F.col(f"{n}_all"))
    chosen = sums.select(*keys, of("n").alias("n"), of("q").alias("q"), *[of(f"m_{c}").cast("int").alias(f"rgb_{c}") for c in CHANNELS], *[of(f"s_{c}").alias(f"s_{c}") for c in CHANNELS])
    square = F.col("q") + sum(F.col("n") * F.col(f"rgb_{c}") * F.col(f"rgb_{c}") - 2 * F.col(f"rgb_{c}") * F.col(f"s_{c}") for c in CHANNELS)
    rgb = [F.col(f"rgb_{c}") for c in CHANNELS]
    return chosen.withColumn("lab", lab_rounded(*rgb)).select(
        *keys, F.col("n").alias("sample_pixel_count"), *rgb, hex_color(*rgb).alias("hex_color"), "lab.*", fixed(F.sqrt(square / F.col("n")), 2).alias("rgb_spread")
    )


def placed(colors: DataFrame) -> DataFrame:
    """With hue_angle and chroma; the published lab_a and lab_b lose the sign of zero only after that."""
    return colors.withColumn("hue_angle", hue(F.col("lab_a"), F.col("lab_b"))).withColumn("chroma", chroma(F.col("lab_a"), F.col("lab_b"))).withColumns({c: F.col(c) + 0.0 for c in ("lab_a", "lab_b")})
