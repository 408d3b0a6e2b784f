"""Text and number rules of catalogue fields, as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The amount pattern (it stops at a thousands comma), and words of the price and type rules.
AMOUNT = r"\$?\s*(\d+(?:\.\d{1,2})?)"
SALE, REGULAR = rf"(?i)sale\s+price\s*{AMOUNT}", rf"(?i)(?:regularly|list\s+price|reg)\s*{AMOUNT}"
TYPE_WORDS = r"(?i)\b(color|shade|size|scent|fragrance|flavor)\b"
VOLUME_UNITS = ("ml", "fl oz")
MISSING = "Not available"


@F.pandas_udf(T.StringType())
def _nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Unicode normal form C; text of ASCII alone doesn't leave the JVM."""
    plain = text.isNull() | (F.octet_length(text) == F.char_length(text))
    return F.when(plain, text).otherwise(_nfc(F.when(~plain, text)))


def strip(text: Column) -> Column:
    """Without white space, Unicode's included, at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def optional_text(text: Column) -> Column:
    """Stripped, in form C, null if nothing is left."""
    return none_if_empty(nfc(strip(text)))


def squeezed(pieces: Column) -> Column:
    """An array of text nodes as one text: stripped, the empty ones dropped, one blank between; null if nothing is left."""
    return none_if_empty(F.array_join(F.filter(F.transform(pieces, strip), lambda t: t != ""), " "))


def number(text: Column) -> Column:
    """A double without `$` and commas; null if it is none. What only Java takes for a number (a trailing d or f, hex) isn't one."""
    bare = F.regexp_replace(strip(F.translate(text, "$,", "")), r"(?<=\d)_(?=\d)", "")
    return F.when(bare.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), bare.try_cast("double")).when(
        F.lower(bare).rlike(r"^[+-]?(nan|inf|infinity)$"), F.regexp_replace(F.regexp_replace(F.lower(bare), "^[+-]?nan$", "nan"), "inf(inity)?", "Infinity").try_cast("double")
    )


def first_group(text: Column, pattern: str) -> Column:
    return none_if_empty(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1))


def prices(pricing: Column, offer: Column) -> Column:
    """(list_price, sale_price): the regular or else the offered price beside a sale price, or the offered one alone."""
    # An amount is digits by its pattern, so a cast is enough.
    sale, regular = (first_group(pricing, p).try_cast("double") for p in (SALE, REGULAR))
    offered = number(offer)
    return F.struct(F.when(sale.isNotNull(), F.coalesce(regular, offered)).otherwise(offered).alias("list_price"), sale.alias("sale_price"))


def rating(value: Column, reviews: Column) -> Column:
    """(rating, review_count); a count that isn't an integer is null."""
    count = strip(F.translate(reviews, ",", ""))
    return F.struct(number(value).alias("rating"), F.when(count.rlike(r"^[+-]?\d+$"), count.try_cast("int")).alias("review_count"))


def size_text(dimension: Column) -> Column:
    """What follows `Size:`, else the whole text."""
    return F.coalesce(strip(first_group(dimension, r"(?i)\bSize:\s*(.+)$")), none_if_empty(dimension))


def without_suffix(text: Column, suffix: Column) -> Column:
    """Without a suffix, whatever its case, and stripped; as it is if it doesn't end so."""
    has = F.lower(text).endswith(F.lower(suffix)) & (F.length(suffix) > 0)
    return F.coalesce(F.when(has, strip(F.substring(text, F.lit(1), F.length(text) - F.length(suffix)))), text)


def without_prefix(text: Column, prefix: Column) -> Column:
    has = F.startswith(F.lower(text), F.lower(prefix)) & (F.length(prefix) > 0)
    return F.coalesce(F.when(has, strip(F.substring(text, F.length(prefix) + 1, F.length(text)))), text)


def product_name(schema_name: Column, shade: Column, heading: Column, brand: Column) -> Column:
    """The structured name without ` - shade`; else the heading without the brand before it."""
    named = none_if_empty(without_suffix(schema_name, F.concat(F.lit(" - "), shade)))
    return F.coalesce(named, without_prefix(heading, brand))


def variant_type(labels: Column, has_color: Column) -> Column:
    """`color` if a colour is given; else the word of the first label that has one, shade being color; else `default`."""
    words = F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda t: F.lower(F.regexp_extract(F.coalesce(t, F.lit("")), TYPE_WORDS, 1)))
    word = F.get(F.filter(words, lambda w: w != ""), F.lit(0))
    return F.when(has_color, "color").when(word == "shade", "color").otherwise(F.coalesce(word, F.lit("default")))


def ingredient_text(text: Column) -> Column:
    """Without the label `ingredients:` before it."""
    return none_if_empty(strip(F.regexp_replace(text, r"(?i)^\s*ingredients?\s*:?\s*", "")))


def unescaped_brackets(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\["), F.lit("[")), F.lit("\\]"), F.lit("]"))


def formula_id(product_id: Column, ingredients: Column) -> Column:
    """SHA-256 of product and ingredients with a zero character between; null without ingredients."""
    return F.when(F.length(ingredients) > 0, F.sha2(F.concat(product_id, F.lit("\0"), ingredients), 256))


def fixed(value: Column, places: int) -> Column:
    """Rounded by the exact binary value, half to even, as a double."""
    return F.replace(F.format_number(value, places), F.lit(","), F.lit("")).try_cast("double")


def price_text(value: Column) -> Column:
    """`$1,234.50`; a missing price says so."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(value.try_cast("double"), 2)), F.lit(MISSING))


def size_label(value: Column, unit: Column) -> Column:
    parts = [F.coalesce(strip(c.cast("string")), F.lit("")) for c in (value, unit)]
    return F.coalesce(none_if_empty(strip(F.concat_ws(" ", *parts))), F.lit(MISSING))


def unit_price_text(value: Column, unit: Column) -> Column:
    """`$x/mL` for volumes, else `$x/g`."""
    per = F.when(F.lower(unit).isin(*VOLUME_UNITS), "/mL").otherwise("/g")
    return F.coalesce(F.concat(F.lit("$"), F.format_number(value.try_cast("double"), 2), per), F.lit(MISSING))


def named(text: Column, missing: str) -> Column:
    return F.coalesce(none_if_empty(text), F.lit(missing))


def required_number(value: Column, what: str, key: Column) -> Column:
    """A double, or an error that names the row."""
    return F.coalesce(value.try_cast("double"), F.raise_error(F.concat(F.lit(f"{what} is missing or invalid for "), F.coalesce(key, F.lit("null")))).cast("double"))


def iso_utc(moment: Column) -> Column:
    """Second precision, with a Z; the session's time zone is UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_id(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd'T'HHmmss'Z'")
