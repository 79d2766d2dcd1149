"""Parquet tables, CSV files, and serving copies."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``; where they are one machine and it is not set, one temporary folder for the session, which goes with the process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("merchlake.work.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names the folder that driver and executors share; it is not set")
        folder = tempfile.mkdtemp(prefix="merchlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        found = f"file://{folder}"
        spark.conf.set("merchlake.work.dir", found)
    return found.rstrip("/")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The table's whole versions, oldest first."""
    p, files = _hadoop(spark, path)
    names = sorted(f.getPath().getName() for f in files.listStatus(p)) if files.exists(p) else []
    return [n for n in names if n.startswith("version-") and files.exists(_hadoop(spark, f"{path}/{n}/_SUCCESS")[0])]


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of a table's newest whole version, the path itself if it has none, None if there is no table."""
    found = _versions(spark, path)
    p, files = _hadoop(spark, path)
    return f"{path}/{found[-1]}" if found else path if files.exists(p) else None


def path_exists(spark: SparkSession, path: str) -> bool:
    p, files = _hadoop(spark, path)
    return files.exists(p)


def table_exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


def read(spark: SparkSession, path: str, columns: Sequence[str] = (), sites: Sequence[str] = ()) -> DataFrame:
    """A stored table, pruned to the columns and sites asked for."""
    df = spark.read.parquet(current(spark, path) or path)
    if sites:
        df = df.where(F.col("site_code").isin(*sites))
    return df.select(*columns) if columns else df


def swap(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a table's next version; df may read the last one.

    A version counts once its write has succeeded, so a crash leaves the last
    one in place.  The last but one goes; readers of the last one go on.
    """
    spark = df.sparkSession
    before = _versions(spark, path)
    number = int(before[-1].rpartition("-")[2]) + 1 if before else 0
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/version-{number:09d}")
    for name in before[:-1]:
        p, files = _hadoop(spark, f"{path}/{name}")
        files.delete(p, True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 2000, **properties: str) -> None:
    """Append to a serving database in batches; the driver jar is the caller's."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch, **properties).mode("append").save()
