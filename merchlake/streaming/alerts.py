"""Alerts that go out once: the ledger is written with them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import first_per_key
from ..operators.upserts import not_in
from ..sources.tables import path_exists


def ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """All alerts so far, with the stream and the batch that found them; None before the first."""
    return spark.read.option("basePath", path).parquet(f"{path}/stream=*") if path_exists(spark, path) else None


def send(found: DataFrame, path: str, name: str, number: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Write the alerts of a batch that no other batch has sent, one for each key, and return them.

    They are a folder named by the stream and the batch.  A batch that comes again
    after a failure leaves its own folder aside when it looks for earlier
    alerts, finds the same ones and puts them in the same place: whatever reads
    the ledger sees each alert once.
    """
    spark = found.sparkSession
    sent = ledger(spark, path)
    new = first_per_key(found, keys, [F.col(c) for c in order])
    if sent is not None:
        others = sent.where((F.col("stream") != name) | (F.col("batch") < number))
        new = not_in(new, others, keys)
    target = f"{path}/stream={name}/batch={number}"
    new.write.mode("overwrite").parquet(target)
    return spark.read.schema(new.schema).parquet(target)


def alert_once(stream: DataFrame, find: Callable[[DataFrame], DataFrame], path: str, name: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Send the alerts that find makes of each batch of a stream, until all that is there is read.

    name belongs to the checkpoint: a stream that starts anew with another
    checkpoint takes another name, and still sends no alert again.
    """

    def batch(rows: DataFrame, number: int) -> None:
        send(find(rows), path, name, number, keys, order)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
