"""Exactly-once landing of new files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import manifests


def ingest_available(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, file_format: str = "parquet") -> None:
    """Take in all files that are new since the last call; the checkpoint is the ledger.

    Each batch is a folder of its own: one that is run again after a failure
    overwrites itself and nothing else.  ``landed`` reads what counts.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.format(file_format).schema(schema).load(source)
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def landed(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """What was taken in: of each (site, run) key, null or not, the rows of the last batch that holds it."""
    rows = spark.read.parquet(target)
    last = rows.groupBy(*(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys))).agg(F.max("batch").alias("_last"))  # a row for each run
    same = F.col("batch") == F.col("_last")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    return rows.join(last, same).select(*(c for c in rows.columns if c != "batch"))


def ingest_partitions(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, keys: Sequence[str], name: str = "ingest", file_format: str = "parquet") -> None:
    """As ``ingest_available``, into a table of partitions (``sources.manifests``): a batch replaces the (site, run) pairs that it holds.

    The table remembers the stream's last batch, so one that comes again after a failure is not written twice.
    """

    def keep(batch: DataFrame, number: int) -> None:
        manifests.write(batch, target, keys, batch=(name, number))

    stream = spark.readStream.format(file_format).schema(schema).load(source)
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def session_counts(stream: DataFrame, when: str, keys: Sequence[str], gap: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of a stream of observations: sessions that a pause of more than gap ends; rows later than late are dropped."""
    return stream.withWatermark(when, late).groupBy(*keys, F.session_window(when, gap).alias("s")).agg(F.count(F.lit(1)).alias("n")).select(*keys, F.col("s.start").alias("run_start"), (F.col("s.end") - F.expr(f"INTERVAL {gap}")).alias("run_end"), "n")


def first_seen(stream: DataFrame, key: str, when: str, late: str = "1 day") -> DataFrame:
    """Each key once, when it first comes, within the watermark."""
    return stream.withWatermark(when, late).dropDuplicatesWithinWatermark([key])
