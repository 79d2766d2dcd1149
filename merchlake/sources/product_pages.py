"""Products from pages that hold them in three places.

A page's base records are joined with variants (another JSON block), with
page addresses and with analytics values found by patterns.  Each source is a
table of its own, keyed by page, so the merge is three left joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import json_unescape
from .records import embedded_json


def _last(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last of equal keys, by the place pos."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("pos")))).where("_rn = 1").drop("_rn", "pos")


def base_records(pages: DataFrame, pattern: str, schema: str) -> DataFrame:
    """page, and the fields of every record, in order of place."""
    return pages.select("page", F.posexplode(embedded_json(F.col("html"), pattern, schema)).alias("pos", "record")).select("page", "pos", "record.*")


def variants(pages: DataFrame, pattern: str, schema: str, key: str = "id", prefix: str = "variant.") -> DataFrame:
    found = pages.select("page", F.posexplode(embedded_json(F.col("html"), pattern, schema)).alias("pos", "v")).where(F.col(f"v.{key}").isNotNull())
    fields = found.select("v.*").columns
    return _last(found.select("page", "pos", F.col(f"v.{key}").alias("_variant"), *(F.col(f"v.`{c}`").alias(prefix + c) for c in fields)), ["page", "_variant"])


def addresses(pages: DataFrame, pattern: str) -> DataFrame:
    """page, _product, product_url by a pattern of two groups: path and product id."""
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(pattern), 1).alias("path"), F.regexp_extract_all("html", F.lit(pattern), 2).alias("id"))
    found = pages.select("page", F.posexplode(pairs).alias("pos", "p")).select("page", "pos", F.col("p.id").try_cast("long").alias("_product"), F.col("p.path").alias("product_url"))
    return _last(found.where("_product IS NOT NULL"), ["page", "_product"])


def analytics(pages: DataFrame, pattern: str, groups: Sequence[str], join_group: str, prefixes: dict[str, str] | None = None) -> DataFrame:
    """page, _key and the groups of a pattern, JSON escapes decoded; groups whose name begins with _ only join."""
    lists = F.arrays_zip(*(F.regexp_extract_all("html", F.lit(pattern), i + 1).alias(g) for i, g in enumerate(groups)))
    found = pages.select("page", F.posexplode(lists).alias("pos", "g"))
    value = lambda g: F.concat(F.lit((prefixes or {}).get(g, "")), json_unescape(F.col(f"g.`{g}`")))
    shown = [value(g).alias(g) for g in groups if not g.startswith("_")]
    return _last(found.select("page", "pos", json_unescape(F.col(f"g.`{join_group}`")).try_cast("long").alias("_key"), *shown).where("_key IS NOT NULL"), ["page", "_key"])


def merge(base: DataFrame, variant_table: DataFrame | None, address_table: DataFrame | None, analytics_table: DataFrame | None, variant_key: Column, product_key: Column) -> DataFrame:
    """Base records with what the other places say; an address found directly is not overwritten."""
    out = base.withColumns({"_variant": variant_key.cast("long"), "_product": product_key.cast("long")})
    if variant_table is not None:
        out = out.join(variant_table.withColumn("_variant", F.col("_variant").cast("long")), ["page", "_variant"], "left")
    if address_table is not None:
        out = out.join(address_table, ["page", "_product"], "left")
    if analytics_table is not None:
        other = analytics_table.withColumnRenamed("_key", "_variant")
        if "product_url" in other.columns and "product_url" in out.columns:
            other = other.withColumnRenamed("product_url", "_url")
            out = out.join(other, ["page", "_variant"], "left").withColumn("product_url", F.coalesce("product_url", "_url")).drop("_url")
        else:
            out = out.join(other, ["page", "_variant"], "left")
    return out.drop("_variant", "_product")
