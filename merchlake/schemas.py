"""Schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"STRING": T.StringType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "BIGINT": T.LongType(), "ARRAY<STRING>": T.ArrayType(T.StringType())}


def schema(fields: str) -> T.StructType:
    """A schema from ``name TYPE, ...``, without a session."""
    return T.StructType([T.StructField(*((x := f.split())[0], _KINDS[x[1]])) for f in fields.split(", ")])


#: The canonical history of products: one row for each source, product and run.
SILVER = schema(
    "silver_id STRING, site_code STRING, source_product_id STRING, fetch_date DATE, fetch_at TIMESTAMP, source_sku STRING, "
    "ean ARRAY<STRING>, url STRING, image_url STRING, currency STRING, list_price_try DOUBLE, sale_price_try DOUBLE, "
    "conditional_promo_price_try DOUBLE, discount_rate DOUBLE, stock_status_raw STRING, is_in_stock BOOLEAN, stock_qty BIGINT, "
    "category_path STRING, name STRING, name_raw STRING, name_normalized STRING, brand STRING, brand_raw STRING, "
    "brand_normalized STRING, size_value DOUBLE, size_unit STRING, name_full_normalized STRING"
)

#: What the mapping of a source gives, before names and prices are normalised.
MAPPED = {
    "id": "string", "source_sku": "string", "ean": "array<string>", "url": "string", "image_url": "string", "currency": "string",
    "list_price_try": "double", "sale_price_try": "double", "conditional_promo_price_try": "double", "discount_rate": "double",
    "stock_status_raw": "string", "is_in_stock": "boolean", "stock_qty": "bigint", "category_path": "string", "name": "string", "brand": "string",
}

LEDGER = schema("object_name STRING, modified TIMESTAMP, site STRING, ingested_at TIMESTAMP")
ALERTED = schema("silver_id STRING, old_effective_price DOUBLE, new_effective_price DOUBLE, alerted_at TIMESTAMP")
URLS = schema("url STRING, first_seen_at TIMESTAMP, last_seen_at TIMESTAMP, is_active BOOLEAN")
