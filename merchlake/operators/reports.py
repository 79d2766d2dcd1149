"""Reports on tables: counts, violations, null rates, profiles, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys have several rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("violations"))


def null_rates(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """field, nulls, pct: one pass over the table; an array of nulls only counts as null."""
    def missing(c: str) -> Column:
        empty = F.col(c).isNull()
        return empty | ~F.exists(c, lambda x: x.isNotNull()) if df.schema[c].dataType.typeName() == "array" else empty

    row = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count_if(missing(c)).alias(c) for c in fields))
    parts = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("nulls")) for c in fields))
    return row.select("_n", F.inline(parts)).select("field", "nulls", F.round(100.0 * F.try_divide("nulls", "_n"), 2).alias("pct"))


def profile(df: DataFrame, sample: int = 120, distinct_error: float | None = None) -> DataFrame:
    """path, dtype, fill_pct, distinct_count, sample_value of every column.

    Exact counts take two steps: pairs of column and value are counted, by each
    task for itself before the shuffle, then the pairs of each column.  What is
    shuffled is each task's distinct values.  With distinct_error, a relative
    standard deviation, sketches count instead, and only one row a task is shuffled.
    """
    if distinct_error is None:
        return _exact_profile(df, sample)
    distinct = lambda c: F.approx_count_distinct(c, distinct_error)
    text = as_text(df)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(text):
        shown = F.substring(F.regexp_replace(F.min(text[c]), "[\r\n]", " "), 1, sample)
        aggs.append(F.struct(F.lit(c).alias("path"), F.lit(dict(df.dtypes)[c]).alias("dtype"), F.count(text[c]).alias("fill"), distinct(text[c]).alias("distinct_count"), shown.alias("sample_value")).alias(f"_c{i}"))
    row = df.agg(*aggs).select("_n", F.inline(F.array(*(f"_c{i}" for i in range(len(text))))))
    return row.select("path", "dtype", F.bround(100.0 * F.try_divide("fill", "_n"), 1).alias("fill_pct"), "distinct_count", "sample_value").orderBy("path")


def as_text(df: DataFrame) -> dict[str, Column]:
    """Each column's values as text, nested ones as JSON."""
    return {c: (F.to_json(F.col(f"`{c}`")) if t.startswith(("array", "struct", "map")) else F.col(f"`{c}`").cast("string")) for c, t in df.dtypes}


def _exact_profile(df: DataFrame, sample: int) -> DataFrame:
    values = F.array(*as_text(df).values())
    pairs = df.select(F.posexplode(values).alias("i", "x")).groupBy("i", "x").agg(F.count(F.lit(1)).alias("n"))
    each = pairs.groupBy("i").agg(F.sum("n").alias("_n"), F.coalesce(F.sum(F.when(F.col("x").isNotNull(), F.col("n"))), F.lit(0)).alias("fill"), F.count("x").alias("distinct_count"), F.min("x").alias("least"))
    # every column has its row, also where the table is empty
    names = df.sparkSession.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)], "i int, path string, dtype string")
    shown = F.substring(F.regexp_replace("least", "[\r\n]", " "), 1, sample)
    told = names.join(F.broadcast(each), "i", "left")  # one row for each column
    return told.select("path", "dtype", F.bround(100.0 * F.try_divide("fill", "_n"), 1).alias("fill_pct"), F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"), shown.alias("sample_value")).orderBy("path")


def sketches(df: DataFrame, by: Sequence[str] = (), precision: int = 12) -> DataFrame:
    """by, path, n, fill, least, most and a sketch of the distinct values of every other column: what a run adds to a stored profile.

    Rows of several runs, or of several tables with the same columns, add up
    by ``merged_profile``: no run is read twice.
    """
    rest = df.drop(*by)
    values = F.array(*(F.struct(F.lit(c).alias("path"), v.alias("x")) for c, v in as_text(rest).items()))
    flat = df.select(*by, F.inline(values))
    return flat.groupBy(*by, "path").agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("fill"), F.min("x").alias("least"), F.max("x").alias("most"), F.hll_sketch_agg("x", precision).alias("sketch"))


def merged_profile(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, path, n, fill, least, most, distinct_count (an estimate) of all the sketches together."""
    both = stored.groupBy(*by, "path").agg(F.sum("n").alias("n"), F.sum("fill").alias("fill"), F.min("least").alias("least"), F.max("most").alias("most"), F.hll_union_agg("sketch", F.lit(True)).alias("sketch"))
    return both.select(*by, "path", "n", "fill", "least", "most", F.hll_sketch_estimate("sketch").alias("distinct_count"))


def activity_counts(urls: DataFrame, snapshots: DataFrame, by: str, snapshot: str = "snapshot_id") -> DataFrame:
    """by, urls, active, passive: the addresses of each site, which their snapshots name; those of no known snapshot are left out.

    Addresses are counted by snapshot before the join, so that no site's rows meet in one task.
    """
    each = urls.groupBy(snapshot).agg(F.count(F.lit(1)).alias("urls"), F.count_if("is_active").alias("active"))
    both = each.join(snapshots.select(snapshot, by).distinct(), snapshot).groupBy(by).agg(F.sum("urls").alias("urls"), F.sum("active").alias("active"))
    return both.withColumn("passive", F.col("urls") - F.col("active"))


def completeness(pages: DataFrame, keys: Sequence[str] = ("site", "category")) -> DataFrame:
    """verdict on each category: collected against declared items.

    pages: keys, page, status, items, declared_total, stop_reason.
    """
    got = pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("items").alias("collected"),
        F.count_if(F.col("status") != 200).alias("blocked"),
        F.max_by(F.struct("declared_total", "stop_reason"), "page").alias("last"),
    )
    verdict = (
        F.when(F.col("last.stop_reason") == "http_error", "incomplete")
        .when(F.col("last.stop_reason") == "max_pages", "abnormal")
        .when(F.col("last.declared_total").isNull(), "unverified")
        .when(F.col("collected") < F.col("last.declared_total"), "maybe_incomplete")
        .otherwise("complete")
    )
    return got.select(*keys, "pages", "collected", "blocked", F.col("last.declared_total").alias("declared"), verdict.alias("verdict"))
