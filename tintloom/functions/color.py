"""Colour science as column expressions: sRGB to CIE L*a*b* (D65), hue, chroma, and crops."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tintloom.functions.text import fixed

# sRGB transfer curve, matrix rows for X, Y, Z, the D65 white point, and the knee of the L*a*b* curve.
KNEE, SLOPE, OFFSET, GAMMA = 0.04045, 12.92, 0.055, 2.4
XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
WHITE = (0.95047, 1.0, 1.08883)
DELTA = 6 / 29


def linear(channel: Column) -> Column:
    """A channel of 0 to 255 on the linear scale of 0 to 1."""
    v = channel / F.lit(255.0)
    return F.when(v <= KNEE, v / SLOPE).otherwise(F.pow((v + OFFSET) / (1 + OFFSET), F.lit(GAMMA)))


def curve(t: Column) -> Column:
    return F.when(t > DELTA**3, F.pow(t, F.lit(1 / 3))).otherwise(t / (3 * DELTA**2) + 4 / 29)


def lab(r: Column, g: Column, b: Column) -> Column:
    """(lab_l, lab_a, lab_b), not rounded."""
    rgb = [linear(c) for c in (r, g, b)]
    x, y, z = (curve((rgb[0] * m[0] + rgb[1] * m[1] + rgb[2] * m[2]) / w) for m, w in zip(XYZ, WHITE, strict=True))
    return F.struct((116 * y - 16).alias("lab_l"), (500 * (x - y)).alias("lab_a"), (200 * (y - z)).alias("lab_b"))


def lab_rounded(r: Column, g: Column, b: Column) -> Column:
    """(lab_l, lab_a, lab_b) with two places; zeros keep their sign, which the hue of a grey depends on."""
    value = lab(r, g, b)
    signed = lambda c: F.when((c < 0) & (fixed(c, 2) == 0), F.lit(-0.0)).otherwise(fixed(c, 2))
    return F.struct(*[signed(value[n]).alias(n) for n in ("lab_l", "lab_a", "lab_b")])


def hue(a: Column, b: Column) -> Column:
    """Degrees in (-180, 180]; where b is zero the zeros' signs decide, as they do for atan2 of IEEE numbers."""
    minus = lambda c: c.cast("string").startswith("-")
    flat = (b == 0) & ((a < 0) | minus(a))
    return F.when(flat, F.when(minus(b), -180.0).otherwise(180.0)).otherwise(F.degrees(F.atan2(b, a)))


def chroma(a: Column, b: Column) -> Column:
    return F.hypot(a, b)


def hex_color(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("#%02x%02x%02x", *[c.cast("int") for c in (r, g, b)])


def crop(size: Column, fraction: float) -> Column:
    """(side, offset) of a centred crop of a dimension: half-even rounding, one pixel at least."""
    side = F.greatest(F.lit(1), F.rint(size * F.lit(float(fraction))).cast("int"))
    return F.struct(side.alias("side"), F.floor((size - side) / 2).cast("int").alias("offset"))
