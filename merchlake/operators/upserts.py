"""Keeping tables current: replace, upsert, append, soft delete.

Each function returns the table's new rows as a DataFrame.  On plain Parquet
the caller writes them to a new folder and swaps (``sources.tables.swap``):
a folder is never overwritten while it is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_by_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of old whose key is in new go, null keys too; all rows of new come. Applying it twice changes nothing."""
    return not_in(old, new, keys).unionByName(new)


def not_in(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key others lack; null keys are keys."""
    return rows.join(*_same(others, keys), "left_anti")


def difference(some: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of some that others lack; null keys are keys."""
    return not_in(some.select(*keys).distinct(), others, keys)


def _same(new: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The distinct keys of new under names of their own, and the condition that a row has one of them."""
    names = [f"_key_{i}" for i in range(len(keys))]
    condition = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        condition &= F.col(k).eqNullSafe(F.col(n))
    return new.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True))).distinct(), condition


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], **stamps: Column) -> DataFrame:
    """new wins on equal keys; stamps are set on its rows."""
    return replace_by_keys(old, new.withColumns(stamps) if stamps else new, keys)


def upsert_preserving(old: DataFrame, new: DataFrame, keys: Sequence[str], preserve: Sequence[str]) -> DataFrame:
    """As upsert, but the preserved columns of rows that exist keep their value."""
    o, n = old.alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    both = o.join(n, [*keys], "full_outer")
    pick = lambda c: F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in preserve else F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(*keys, *(pick(c).alias(c) for c in old.columns if c not in keys)).select(*old.columns)


def insert_if_absent(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old, and the rows of new whose key it lacks, one for each key."""
    return old.unionByName(new.dropDuplicates([*keys]).join(old.select(*keys), [*keys], "left_anti"))


def append_by_name(old: DataFrame, new: DataFrame) -> DataFrame | None:
    """Both tables with all columns of either; None if a shared column's type conflicts, so that the caller rebuilds."""
    a, b = dict(old.dtypes), dict(new.dtypes)
    if any(a[c] != b[c] for c in a.keys() & b.keys()):
        return None
    return old.unionByName(new, allowMissingColumns=True)


def union_sources(*frames: DataFrame, schema: dict[str, str]) -> DataFrame:
    """All rows by name, cast to the schema, missing columns null."""
    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*((F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in schema.items()))

    out = shaped(frames[0])
    for f in frames[1:]:
        out = out.unionByName(shaped(f))
    return out


def with_defaults(df: DataFrame, **defaults: Column) -> DataFrame:
    """Each named column as it is, its default where it is null or missing: ``created_at=F.current_timestamp()``, say."""
    have = set(df.columns)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), d) if c in have else d for c, d in defaults.items()})


def with_surrogate(df: DataFrame, keys: Sequence[str], name: str = "id") -> DataFrame:
    """A surrogate id that follows from the natural key, the same in every run: MD5 of its parts, parted by ``|``, null as ``\\N``."""
    part = lambda k: F.coalesce(F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")), F.lit("\\N"))
    return df.withColumn(name, F.md5(F.concat_ws("|", *(part(k) for k in keys))))


def sync_activity(existing: DataFrame, current: DataFrame, now: Column, key: str = "url", most_stale: float = 0.5) -> DataFrame:
    """A snapshot diff: new keys come in, the others are seen again; active ones that are missing turn inactive, which sets last_seen_at too.

    If existing has active rows and current is empty, or more than most_stale
    of the active rows are missing from it, the batch is refused and existing
    comes back unchanged.  existing: key, first_seen_at, last_seen_at, is_active.
    """
    seen = current.select(key).distinct().withColumn("_seen", F.lit(True))
    both = existing.join(seen, key, "full_outer").withColumns({"_seen": F.coalesce("_seen", F.lit(False)), "_old": F.col("is_active").isNotNull()})
    active = F.coalesce("is_active", F.lit(False))
    counts = both.agg(F.count_if(active).alias("_active"), F.count_if(active & ~F.col("_seen")).alias("_stale"), F.count_if("_seen").alias("_current"))
    refused = (F.col("_active") > 0) & ((F.col("_current") == 0) | (F.col("_stale") / F.col("_active") > most_stale))
    guard = F.broadcast(counts.select(refused.alias("_refused")))  # one row
    keep = F.col("_refused")
    return (
        both.join(guard, F.lit(True))
        .where(F.col("_old") | ~keep)
        .select(
            key,
            F.when(F.col("_old"), F.col("first_seen_at")).otherwise(now).alias("first_seen_at"),
            F.when(~keep & (F.col("_seen") | active), now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
            F.when(keep, F.col("is_active")).otherwise(F.col("_seen")).alias("is_active"),
        )
    )


def changed_hashes(new: DataFrame, last: DataFrame, key: str, digest: str) -> DataFrame:
    """The rows of new whose digest differs from the last one stored, or that are new."""
    before = last.select(key, F.col(digest).alias("_before"))
    return new.join(before, key, "left").where(~F.col(digest).eqNullSafe(F.col("_before"))).drop("_before")


def set_hash(df: DataFrame, keys: Sequence[str], value: str, name: str = "content_hash") -> DataFrame:
    """SHA-256 of each group's distinct values in order, joined by line feeds; nulls do not count, a group of nulls has the hash of nothing.

    The values of a group come in order to one task, which keeps a running
    digest and never the values: a group may be larger than memory.
    """
    rows = df.select(*keys, F.col(value).cast("string").alias("_value")).distinct()
    kinds = ", ".join(f"`{k}` {t}" for k, t in rows.dtypes if k != "_value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, begun = None, None, False
        told: list[tuple] = []
        schema = None

        def flush() -> pa.RecordBatch:
            cols = zip(*told, strict=True) if told else [()] * (len(keys) + 1)
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
            told.clear()
            return out

        for b in batches:
            schema = schema or pa.schema([*(b.schema.field(k) for k in keys), pa.field(name, pa.string())])
            parts = zip(*(b.column(k).to_pylist() for k in keys), strict=True) if keys else ((),) * b.num_rows
            for key, x in zip(parts, b.column("_value").to_pylist(), strict=True):
                if held is None or key != now:
                    if held is not None:
                        told.append((*now, held.hexdigest()))
                    now, held, begun = key, hashlib.sha256(), False
                if x is not None:
                    held.update((("\n" if begun else "") + x).encode())
                    begun = True
            if len(told) >= 10_000:
                yield flush()
        if held is not None:
            told.append((*now, held.hexdigest()))
        if told:
            yield flush()

    order = [*keys, "_value"]
    dealt = rows.repartition(*keys) if keys else rows.coalesce(1)
    return dealt.sortWithinPartitions(*order).mapInArrow(run, f"{kinds}, `{name}` string" if keys else f"`{name}` string")
