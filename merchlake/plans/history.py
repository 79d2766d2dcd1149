"""From raw records to the canonical history: clean, enrich, normalise, replace by run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import parse_size, positive
from ..functions.text import clean_text, name_with_brand, normalize_key
from ..operators.rows import first_per_key, latest_per_key
from ..operators.upserts import append_by_name, replace_by_keys
from ..schemas import SILVER
from ..sources import manifests
from ..sources.records import drop_prefixes, flatten, quoted, whitelist

#: Columns that a lookup may add to a source's records; null where it is absent.
SUPPLEMENT = {"product_id": "string", "ean_html": "array<string>", "price_html": "bigint", "qty_html": "bigint", "html_fetch_date": "date"}
#: Lookups up to this many rows are broadcast.
SMALL_ROWS = 200_000


def land(raw: DataFrame | None, batch: DataFrame, prefixes: Sequence[str] = ()) -> DataFrame:
    """The raw table after a batch: flattened, pruned, appended by name; where types conflict the batch starts it anew."""
    new = drop_prefixes(flatten(batch), prefixes)
    if raw is None:
        return new
    both = append_by_name(raw, new)
    return new if both is None else both


def clean(raw: DataFrame, columns: Sequence[str], product: str, run: str = "_ingested_at", row_id: str = "_row_id", drop: Sequence[str] = (), add: Mapping[str, str] | None = None) -> DataFrame:
    """Approved columns, one row for each product and run: the one that came first.

    A source's overrides: columns to drop, and columns to add by SQL over the approved ones.
    """
    out = first_per_key(whitelist(raw, columns), [quoted(product), quoted(run)], [F.col(quoted(row_id))])
    return out.withColumns({k: F.expr(v) for k, v in (add or {}).items()}).drop(*drop)


def supplement_lookup(found: DataFrame) -> DataFrame:
    """The latest supplement of each product."""
    return latest_per_key(found, ["product_id"], "html_fetch_date", ["_row_id"]).select(*SUPPLEMENT)


def with_supplement(df: DataFrame, product: str, lookup: DataFrame | None, rows: int | None = None) -> DataFrame:
    """The lookup's columns beside each record; nulls of the same types where there is no lookup.

    rows is the lookup's known size: only then, and if it is small, is it broadcast.
    """
    extra = {c: t for c, t in SUPPLEMENT.items() if c != "product_id"}
    if lookup is None:
        return df.withColumns({c: F.lit(None).cast(t) for c, t in extra.items()})
    side = lookup.select(F.col("product_id").alias("_pid"), *extra)
    if rows is not None and rows <= SMALL_ROWS:
        side = F.broadcast(side)
    return df.join(side, df[product].cast("string") == side["_pid"], "left").drop("_pid")


def silver_id(site: Column, product: Column, fetch_at: Column) -> Column:
    """A key that does not depend on any engine's way to print a time."""
    return F.md5(F.concat(site, F.lit("_"), product, F.lit("_"), F.date_format(fetch_at, "yyyy-MM-dd HH:mm:ss")))


def normalise(mapped: DataFrame, fetch_at: str = "_ingested_at") -> DataFrame:
    """Mapped records in the canonical schema. Rows without a product id go; prices that are not above zero become null."""
    size = parse_size(F.col("name_raw"))
    return (
        mapped.where("id IS NOT NULL")
        .withColumnsRenamed({"id": "source_product_id", "name": "name_raw", "brand": "brand_raw", fetch_at: "fetch_at"})
        .withColumns({"name": clean_text(F.col("name_raw")), "brand": clean_text(F.col("brand_raw")), "name_normalized": normalize_key(F.col("name_raw")), "brand_normalized": normalize_key(F.col("brand_raw")), "_size": size, "fetch_date": F.to_date("fetch_at")})
        .withColumns({c: positive(F.col(c)) for c in ("list_price_try", "sale_price_try", "conditional_promo_price_try")})
        .withColumns({"size_value": F.col("_size.value"), "size_unit": F.col("_size.unit"), "name_full_normalized": name_with_brand(F.col("name_normalized"), F.col("brand_normalized")), "silver_id": silver_id(F.col("site_code"), F.col("source_product_id"), F.col("fetch_at"))})
        .select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER))
    )


def replace_runs(history: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The history after a batch: all rows of the batch's (site, run) pairs are replaced; another schema starts it anew."""
    if history is None or set(history.columns) != set(batch.columns):
        return batch
    return replace_by_keys(history, batch, ["site_code", "fetch_at"])


def store_runs(batch: DataFrame, root: str, source: tuple[str, int] | None = None) -> int:
    """``replace_runs`` on a stored history: only the partitions of the batch's (site, run) pairs are written, another schema starts it anew.

    source is a stream's name and the number of its batch, which is then written once.
    """
    spark = batch.sparkSession
    last = manifests.manifest(spark, root)
    anew = last is not None and {f["name"] for f in last["schema"]["fields"]} != set(batch.columns)
    return manifests.write(batch, root, ["site_code", "fetch_at"], batch=source, rebuild=True, anew=anew)
