"""Tables of partition folders with a list of the live ones.

A batch writes the partitions that it holds into a folder of its own, then a
new list (a manifest) takes their folders in and drops those they
replace.  Nothing else is rewritten or moved, and what is live changes with one
rename: until then, and after a crash, readers see the table as it was.

    root/data/<batch>/_part=<digest of the keys>/part-*.parquet
    root/manifests/<number>.json

Keys stay columns of the files, so their types and nulls survive.  The
manifest holds the table's schema, so old partitions get nulls for columns that came later,
and a read opens no file to find that out.  It has one entry for each partition, which
the driver holds; rows never pass through it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.upserts import with_surrogate
from .tables import _hadoop

PART = "_part"


def _names(spark: SparkSession, folder: str) -> list[str]:
    p, files = _hadoop(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(p)) if files.exists(p) else []


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n[:-5]) for n in _names(spark, f"{root}/manifests") if n.endswith(".json") and n[0] != "."]


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict[str, Any] | None:
    """A table's newest list, or an earlier one: number, schema, keys, parts, batches. None if there is no table."""
    found = _numbers(spark, root)
    if not found:
        return None
    return json.loads(spark.read.text(f"{root}/manifests/{number if number is not None else found[-1]:09d}.json", wholetext=True).first()[0])


def _publish(spark: SparkSession, root: str, table: dict[str, Any]) -> None:
    """Make a list the newest one; an error if another writer came first."""
    draft, files = _hadoop(spark, f"{root}/manifests/.{uuid.uuid4().hex}")
    target, _ = _hadoop(spark, f"{root}/manifests/{table['number']:09d}.json")
    out = files.create(draft)
    out.write(json.dumps(table).encode())
    out.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise RuntimeError(f"{root}: another batch was written meanwhile; run this one again")


def _digested(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """With _part, which follows from the keys alone: a time counts by its microseconds, whatever the session's zone."""
    kinds = dict(df.dtypes)
    told = {f"_key_{i}": F.unix_micros(k) if kinds[k] == "timestamp" else F.col(k) for i, k in enumerate(keys)}
    return with_surrogate(df.withColumns(told), [*told], PART).drop(*told)


def merged(old: StructType, new: StructType) -> StructType | None:
    """The fields of both; None if one has another type in each."""
    have = {f.name: f.dataType for f in old}
    if any(have.get(f.name, f.dataType) != f.dataType for f in new):
        return None
    return StructType([*old, *(f for f in new if f.name not in have)])


def write(df: DataFrame, root: str, keys: Sequence[str], batch: tuple[str, int] | None = None, rebuild: bool = False, anew: bool = False) -> int:
    """Replace the table's partitions whose keys df has, null keys too, by the rows of df; the number of the new list.

    Writing the same rows again changes nothing but their folders.  batch,
    a stream's name and number, is remembered: one that is not newer than the stream's last one is not
    written again.  Where a shared column has another type the table starts anew if
    rebuild says so, else this is an error; with anew it does in any case.  Rows of one large partition are
    written by several tasks.
    """
    spark, last = df.sparkSession, manifest(df.sparkSession, root)
    if batch and last and last["batches"].get(batch[0], -1) >= batch[1]:
        return last["number"]
    schema = StructType([f.__class__(f.name, f.dataType, True) for f in df.schema])
    kept, batches = [], {}
    if last and anew:
        batches = last["batches"]
    elif last:
        if last["keys"] != [*keys]:
            raise ValueError(f"the table's keys are {last['keys']}")
        both = merged(StructType.fromJson(last["schema"]), schema)
        if both is None and not rebuild:
            raise ValueError("a column has another type than in the table")
        kept, batches = (last["parts"] if both else []), last["batches"]
        schema = both or schema
    folder = f"data/{uuid.uuid4().hex}"
    rows = _digested(df, keys)
    rows.hint("rebalance", PART).write.partitionBy(PART).parquet(f"{root}/{folder}")
    told = F.to_json(F.struct(*(F.col(k).cast("string").alias(k) for k in keys)), {"ignoreNullFields": "false"})
    found = spark.read.schema(rows.schema).parquet(f"{root}/{folder}").groupBy(PART).agg(F.min(told).alias("told"), F.count(F.lit(1)).alias("n")).collect()  # a row for each partition
    new = {r[PART]: {"id": r[PART], "path": f"{folder}/{PART}={r[PART]}", "values": json.loads(r.told), "rows": r.n} for r in found}
    number = (last["number"] if last else 0) + 1
    _publish(spark, root, {"number": number, "schema": schema.jsonValue(), "keys": [*keys], "batches": batches | (dict([batch]) if batch else {}), "parts": [p for p in kept if p["id"] not in new] + [*new.values()]})
    return number


def read(spark: SparkSession, root: str, where: Mapping[str, Sequence[str | None]] | None = None, number: int | None = None) -> DataFrame:
    """The live rows; of the partitions only whose keys, as text, are among those of where."""
    table = manifest(spark, root, number)
    if table is None:
        raise FileNotFoundError(root)
    schema = StructType.fromJson(table["schema"])
    paths = [f"{root}/{p['path']}" for p in table["parts"] if all(p["values"][k] in v for k, v in (where or {}).items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove what the last lists do not name: replaced partitions and those of cut-off batches. Not beside a writer. The number of folders removed."""
    numbers = _numbers(spark, root)
    live = {p["path"] for n in numbers[-keep:] for p in manifest(spark, root, n)["parts"]}
    gone = [f"data/{b}/{p}" for b in _names(spark, f"{root}/data") for p in _names(spark, f"{root}/data/{b}") if p.startswith(f"{PART}=") and f"data/{b}/{p}" not in live]
    for name in gone + [f"manifests/{n:09d}.json" for n in numbers[:-keep]]:
        p, files = _hadoop(spark, f"{root}/{name}")
        files.delete(p, True)
    used = {x.split("/")[1] for x in live}
    for b in _names(spark, f"{root}/data"):
        if b not in used:
            p, files = _hadoop(spark, f"{root}/data/{b}")
            files.delete(p, True)
    return len(gone)
