"""Catalogue cleaning and its join to the listings."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyspark.operators.listings import positive_int

IMAGE_PREFIX = "https://m.media-amazon.com/images/I/"  # fixed value: where image tokens are resolved
FIELDS = {
    "keepa_title": "string", "keepa_brand": "string", "keepa_manufacturer": "string", "keepa_number_of_items": "int", "keepa_package_quantity": "int",
    "keepa_item_weight_g": "int", "keepa_size": "string", "keepa_features": "string", "keepa_description": "string", "keepa_image_count": "int",
    "keepa_main_image_url": "string", "keepa_image_urls": "string", "keepa_variation_count": "int",
}
SCRAPED = {
    "title": "keepa_title", "brand": "keepa_brand", "manufacturer": "keepa_manufacturer", "size": "keepa_size", "description": "keepa_description",
}
NUMBERS = {"numberOfItems": "keepa_number_of_items", "packageQuantity": "keepa_package_quantity", "itemWeight": "keepa_item_weight_g"}


def clean_text(value: Column) -> Column:
    text = F.trim(value.cast("string"))
    return F.when((text != "") & (F.lower(text) != "nan"), text)


def tokens(value: Column) -> Column:
    return F.filter(F.split(F.coalesce(clean_text(value), F.lit("")), ","), lambda x: x != "")


def _literal(text: str | None) -> str | None:
    s = (text or "").strip()
    if s in ("", "nan", "[]"):
        return None
    try:
        value = ast.literal_eval(s)
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return s
    if not isinstance(value, list | tuple):
        return s
    return " | ".join(x for x in (str(v).strip() for v in value) if x) or None


@F.pandas_udf(StringType())
def features_text(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Items of a Python list literal joined by " | "; anything else as it is."""
    for v in values:
        yield v.map(_literal, na_action="ignore").astype("object")


def latest(catalog: DataFrame, key: str = "asin", position: str = "pos") -> DataFrame:
    """The last row of each key; rows without a key are left out, as they match nothing. Rows are summed up map-side, so a hot key is one row a task."""
    rest = [c for c in catalog.columns if c != key]
    last = F.max_by(F.struct(*rest), position).alias("_last")
    return catalog.filter(F.col(key).isNotNull()).groupBy(key).agg(last).select(key, "_last.*").select(*catalog.columns)


def catalog_fields(catalog: DataFrame) -> DataFrame:
    """One select: cleaned texts, positive numbers, images and counts; absent columns are null."""
    have = set(catalog.columns)
    get = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    images, variations = tokens(get("imagesCSV")), tokens(get("variationCSV"))
    urls = F.transform(images, lambda x: F.concat(F.lit(IMAGE_PREFIX), x))
    cols = {new: clean_text(get(old)) for old, new in SCRAPED.items()} | {new: positive_int(get(old)) for old, new in NUMBERS.items()}
    cols |= {
        "keepa_features": features_text(get("features")), "keepa_image_count": F.nullif(F.size(images), F.lit(0)), "keepa_main_image_url": F.get(urls, F.lit(0)),
        "keepa_image_urls": F.when(F.size(urls) > 0, F.array_join(urls, " | ")), "keepa_variation_count": F.nullif(F.size(variations), F.lit(0)),
    }
    return catalog.select("asin", *[cols[k].cast(t).alias(k) for k, t in FIELDS.items()])


def attach(listings: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """Listings with the catalogue's fields; every listing stays. Without a catalogue the fields are null."""
    if catalog is None:
        return listings.select("*", *[F.lit(None).cast(t).alias(k) for k, t in FIELDS.items()], F.lit(False).alias("keepa_present"))
    fields = catalog_fields(latest(catalog)).withColumn("keepa_present", F.lit(True)).withColumnRenamed("asin", "_asin")
    # Listings without an id match nothing; they are dealt by their content, not as one hot key.
    key = F.coalesce("asin", F.concat(F.lit("\0"), F.xxhash64(*listings.columns).cast("string")))
    joined = listings.withColumn("_key", key).join(fields, F.col("_key") == F.col("_asin"), "left").drop("_key", "_asin")
    return joined.withColumn("keepa_present", F.coalesce("keepa_present", F.lit(False)))
