"""First and latest rows, row numbers, sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.  Catalyst cuts each task's rows to one per key before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], when: str, ties: Sequence[str] = ()) -> DataFrame:
    return first_per_key(df, keys, [F.desc_nulls_last(when), *(F.asc_nulls_last(t) for t in ties)])


def with_row_ids(df: DataFrame, block: Column, order: Sequence[Column], offset: int = 0, name: str = "_row_id") -> DataFrame:
    """Rows numbered from offset in a total order, block by block.

    block rises with the order (a day of the timestamp, say): blocks are
    numbered side by side and shifted by the rows of earlier blocks, so the
    order needs no single sorting task.
    """
    rows = df.withColumn("_block", block)
    sizes = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    numbered = rows.withColumn("_in", F.row_number().over(Window.partitionBy("_block").orderBy(*order)) - 1)
    return numbered.join(before, "_block").withColumn(name, F.col("_in") + F.col("_before") + offset).drop("_block", "_in", "_before")


def with_sorted_row_ids(df: DataFrame, order: Sequence[Column], folder: str, offset: int = 0, name: str = "_row_id") -> DataFrame:
    """Rows numbered from offset in a total order, by as many tasks as there are range partitions.

    The rows are written to the new folder in that order, a file for each
    partition; a row's number is its place in its file after the rows of the
    files before.  There is one count for each file, so that side is small.
    """
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(folder)
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")
    placed = df.sparkSession.read.schema(df.schema).parquet(folder).select("*", F.struct(part.alias("part"), F.col("_metadata.file_name").alias("file")).alias("_file"), F.col("_metadata.row_index").alias("_in"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_file").withColumn(name, F.col("_in") + F.col("_before") + offset).drop("_file", "_in", "_before")


def next_row_id(table: DataFrame, name: str = "_row_id") -> DataFrame:
    return table.agg((F.coalesce(F.max(name), F.lit(-1)) + 1).alias("next_row_id"))


def sessions(df: DataFrame, keys: Sequence[str], when: str, gap: str, ties: Sequence[str] = ()) -> DataFrame:
    """Adds session (from 1 within the keys) and session_end: a new one begins where the pause is longer than gap."""
    own = Window.partitionBy(*keys)
    order = own.orderBy(when, *ties)
    pause = F.col(when) - F.lag(when).over(order)
    opened = F.when(pause.isNull() | (pause > F.expr(f"INTERVAL {gap}")), 1).otherwise(0)
    marked = df.withColumn("_open", opened).withColumn("session", F.sum("_open").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_open")
    return marked.withColumn("session_end", F.max(when).over(Window.partitionBy(*keys, "session")))


def sessions_by_range(df: DataFrame, keys: Sequence[str], when: str, gap: str, folder: str, ties: Sequence[str] = ()) -> DataFrame:
    """As ``sessions``, but no key needs one task: one may hold all rows.

    The rows are written to the new folder, range-partitioned by key and time.  Each
    key's rows are cut into sessions within each range; a table of edges, with
    one row for each range and key, says which ranges' first session goes on with the
    last one before, and so how many sessions come before a range and when those at its
    edges end.  The windows over rows are bounded by a range, those over
    edges by the number of ranges.
    """
    order = [*keys, when, *ties]
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(folder)
    rows = df.sparkSession.read.schema(df.withColumn("_range", F.lit(0)).schema).parquet(folder)
    own = Window.partitionBy("_range", *keys)
    in_order = own.orderBy(when, *ties)
    pause = F.expr(f"INTERVAL {gap}")
    before = F.lag(when).over(in_order)
    opened = F.when(before.isNull() | (F.col(when) - before > pause), 1).otherwise(0)
    cut = rows.withColumn("_open", opened).withColumn("_local", F.sum("_open").over(in_order.rowsBetween(Window.unboundedPreceding, 0))).drop("_open")
    cut = cut.withColumn("_end", F.max(when).over(Window.partitionBy("_range", *keys, "_local")))

    # edges: first and last time, the number of sessions and when the first one ends
    edges = cut.groupBy("_range", *keys).agg(F.min(when).alias("_from"), F.max(when).alias("_to"), F.max("_local").alias("_n"), F.min("_end").alias("_first_end"))
    along = Window.partitionBy(*keys).orderBy("_range")
    went_on = F.coalesce(F.col("_from") - F.lag("_to").over(along) <= pause, F.lit(False))
    edges = edges.withColumn("_on", went_on.cast("int")).withColumn("_before", F.sum(F.col("_n") - F.col("_on")).over(along) - F.col("_n"))
    # the sessions at both edges, which others may share: they end with the last of them
    both = F.array(F.struct(F.lit(1).alias("_k"), F.col("_first_end").alias("_last")), F.struct(F.col("_n").alias("_k"), F.col("_to").alias("_last")))
    shared = edges.select("_range", *keys, "_n", "_before", F.inline(both)).withColumn("_true", F.max("_last").over(Window.partitionBy(*keys, F.col("_before") + F.col("_k"))))
    told = shared.groupBy("_range", *keys, "_n", "_before").agg(F.max(F.when(F.col("_k") == 1, F.col("_true"))).alias("_first_true"), F.max(F.when(F.col("_k") == F.col("_n"), F.col("_true"))).alias("_last_true"))
    names = {k: f"_edge_{i}" for i, k in enumerate(["_range", *keys])}
    same = F.lit(True)
    for k, n in names.items():
        same &= F.col(k).eqNullSafe(F.col(n))
    end = F.when(F.col("_local") == F.col("_n"), F.col("_last_true")).when(F.col("_local") == 1, F.col("_first_true")).otherwise(F.col("_end"))
    out = cut.join(told.withColumnsRenamed(names), same)
    return out.select(*(F.col(f"`{c}`") for c in df.columns), (F.col("_before") + F.col("_local")).alias("session"), end.alias("session_end"))


def run_stamps(objects: DataFrame, site: str = "site", when: str = "modified", gap: str = "15 MINUTES", run_time=None) -> DataFrame:
    """Adds run_at: the end of the object's session, or run_time where the whole backlog of a site is one session.

    run_time is a value, or a column that is null for sites whose run has no time of its own: they keep the session's end.
    """
    out = sessions(objects, [site], when, gap, ["name"])
    if run_time is None:
        return out.withColumnRenamed("session_end", "run_at")
    one = F.max("session").over(Window.partitionBy(site)) == 1
    return out.withColumn("run_at", F.when(one, F.coalesce(F.lit(run_time), F.col("session_end"))).otherwise(F.col("session_end"))).drop("session_end")
