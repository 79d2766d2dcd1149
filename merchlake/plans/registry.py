"""Where queries and their SQL twins are kept, and what all of them use."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all tasks: a table in one small file gives one or two, and what costs much for each row would stay in them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{tables.work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def decimal_round(c, n: int):
    """Rounded through a decimal, so that engines agree on ties."""
    return F.round(c.cast("decimal(24,8)"), n).cast("double")
