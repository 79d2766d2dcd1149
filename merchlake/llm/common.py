"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Stands in for a null doc_id where documents are ordered: after all others.
LAST_ID = 2**63 - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is made once and kept in the session's
    settings, but only where driver and executors are one machine (a local master).
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("merchlake.work.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names the folder that driver and executors share; it is not set")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="merchlake-")
        spark.conf.set("merchlake.work.dir", found)
    return found.rstrip("/")


_watching: list[list] = []


@contextmanager
def watched() -> Iterator[list]:
    """A list of the Stages that are made meanwhile."""
    made: list[Stage] = []
    _watching.append(made)
    try:
        yield made
    finally:
        _watching.remove(made)


class Stage:
    """Tables written in the shared folder to cut lineage.

    A lost executor costs only the tasks of the step at hand: earlier steps
    are files.  ``drop`` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.made = 0
        for made in _watching:
            made.append(self)

    def clear(self) -> None:
        """Remove all its tables."""
        path, files = hadoop_path(self.spark, self.root)
        files.delete(path, True)

    def write(self, df: DataFrame, label: str = "t") -> DataFrame:
        return self.write_by(df, label)

    def write_by(self, df: DataFrame, label: str, *folders: str) -> DataFrame:
        """folders: columns that get a folder for each value, so that a filter on them reads no other."""
        self.made += 1
        path = f"{self.root}/{self.made:03d}-{label}"
        df.write.mode("overwrite").partitionBy(*folders).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_path = path
        return out

    def drop_part(self, table: DataFrame, folder: str) -> None:
        """Remove one folder of a table that ``write_by`` wrote."""
        path, files = hadoop_path(self.spark, f"{table._staged_path}/{folder}")
        files.delete(path, True)

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables, and let go of the shuffle files of finished steps."""
        for t in tables:
            path, files = hadoop_path(self.spark, t._staged_path)
            files.delete(path, True)
        let_go(self.spark)


def let_go(spark: SparkSession) -> None:
    """Shuffle files live as long as the driver's objects: collect those.  One collection leaves the last step's files, a second takes them."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_bytes(table: DataFrame) -> int:
    """The size of a staged table on disk."""
    path, files = hadoop_path(table.sparkSession, table._staged_path)
    return files.getContentSummary(path).getLength()


#: A key that holds one part in HOT of all rows is joined by a broadcast; there are HOT of them at most.
HOT = 1000


def join_counted(rows: DataFrame, keyed: DataFrame, by: list[str]) -> DataFrame:
    """rows joined with keyed, which has each key once with n, how many of the rows have it; n goes.

    rows and keyed are staged.  Keys that hold a thousandth of the rows each
    never number more than a thousand: those are broadcast, so that no task
    gets all the rows of one.
    """
    few = F.col("n") * HOT < rows.count()
    hot, cold = keyed.where(~few).drop("n"), keyed.where(few).drop("n")
    rest = rows.join(F.broadcast(hot.select(*by)), by, "left_anti")
    return rows.join(F.broadcast(hot), by).unionByName(rest.join(cold, by))


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], pa.RecordBatch | None], schema) -> DataFrame:
    """Apply fn to slices of Arrow batches given as Python lists; slices hold about 4 MB of text at most, and one row at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for b in batches:
                rows = max(1, min(b.num_rows, int(4_000_000 * b.num_rows / max(1, b.nbytes))))
                for at in range(0, b.num_rows, rows):
                    part = b.slice(at, rows)
                    out = fn({n: part.column(i) for i, n in enumerate(part.schema.names)})
                    if out is not None and out.num_rows:
                        yield out
        finally:
            b = part = out = None
            give_back()

    if not isinstance(schema, str):
        schema = StructType([StructField(f.name, f.dataType, True) for f in schema])
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that a task has freed to the system: Python workers live on, and what they keep adds up over an executor's stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def word_list(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; bytes.split() splits at just these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Grams:
    """Hashes of n-grams of word hashes.

    With an odd base b, the prefix sums S_i of h_j * b**j (mod 2**64) give
    the gram at i as (S_{i+n} - S_i) * b**-i: one pass for any n.
    """

    def __init__(self, which: int = 0):
        self.base = _ODD[which]
        self.inverse = pow(self.base, -1, 2**64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            m = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                up, down = np.full(m, self.base, np.uint64), np.full(m, self.inverse, np.uint64)
                up[0] = down[0] = 1
                self.up, self.down = np.cumprod(up), np.cumprod(down)

    def sums(self, h: np.ndarray) -> np.ndarray:
        self._grow(len(h) + 1)
        s = np.zeros(len(h) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(h * self.up[: len(h)], out=s[1:])
        return s

    def spans(self, s: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words begin..end-1 for each pair."""
        with np.errstate(over="ignore"):
            return mix((s[end] - s[begin]) * self.down[begin] + (end - begin).astype(np.uint64))

    def windows(self, h: np.ndarray, n: int) -> np.ndarray:
        if len(h) < n:
            return np.zeros(0, np.uint64)
        s = self.sums(h)
        with np.errstate(over="ignore"):
            return mix((s[n:] - s[:-n]) * self.down[: len(h) - n + 1] + np.uint64(n))


class Recent(dict):
    """Values made on first use.

    Two generations of at most ``limit`` entries keep what is used often.  Strings of
    more than ``longest`` characters are made anew each time, so that keys
    and what is made of them have bounded sizes, and with them the memory.
    """

    def __init__(self, make: Callable, limit: int, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        if isinstance(key, str) and len(key) > self.longest:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
