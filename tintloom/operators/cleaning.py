"""From variants to cleaned variants: effective price, size, unit price and category. These rules are this engine's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = r"(?i)([0-9]*\.?[0-9]+)\s*(?:\(x([0-9]+)\))?\s*(fl oz|oz|ml|g|ct)\b"
GRAMS_PER_OUNCE, ML_PER_FLUID_OUNCE = 28.3495, 29.5735


def size(size_text: Column) -> Column:
    """(size_value, size_unit) of a text such as `0.12 (x2) oz`; null where there is none, as in a leaked `Color: Light`."""
    group = lambda i: F.regexp_extract(F.coalesce(size_text, F.lit("")), SIZE, i)
    times = F.when(group(2) != "", group(2).try_cast("double")).otherwise(1.0)
    return F.struct((group(1).try_cast("double") * times).alias("size_value"), F.when(group(3) != "", F.lower(group(3))).alias("size_unit"))


def cleaned(variants: DataFrame, products: DataFrame) -> DataFrame:
    """The columns that the colour map asks for, and `category`: with or without a swatch."""
    sized = variants.withColumn("__s", size(F.col("size_text"))).withColumn("effective_price", F.coalesce("sale_price", "list_price"))
    unit, value = F.col("__s.size_unit"), F.col("__s.size_value")
    amount = F.when(unit == "oz", value * GRAMS_PER_OUNCE).when(unit == "fl oz", value * ML_PER_FLUID_OUNCE).when(unit.isin("g", "ml"), value)
    joined = sized.join(products.select("product_id", "brand", "product_name"), "product_id", "left")
    return joined.select(
        "product_id", "sku_id", "brand", "product_name", "variant_name", "variant_url", "swatch_image_url", "variant_image_url", "effective_price", value.alias("size_value"), unit.alias("size_unit"),
        (F.col("effective_price") / F.when(amount > 0, amount)).alias("price_per_g_ml"), F.when(F.col("swatch_image_url").isNotNull(), "with_swatch").otherwise("no_swatch").alias("category"),
    )
