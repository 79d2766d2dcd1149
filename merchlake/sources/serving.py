"""The serving copy: a database table read by ranges of its key, and written by upserts that all come or none.

``spark.read.format("serving")`` and ``df.write.format("serving")`` after
``register``.  The database is any DB-API module whose SQL knows ``INSERT ... ON CONFLICT``; the
default is sqlite3, with database a path that all tasks reach.

Options: module, database, table, key (an integer column for reads; for writes names with
commas between them), partitions (of a read, 8), batch (rows at a time,
2000), preserve (columns that an upsert leaves as they are where the row exists, names with commas).
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import DoubleType, LongType, Row, StringType, StructField, StructType


def _connect(options: dict[str, str]) -> Any:
    module = importlib.import_module(options.get("module", "sqlite3"))
    return module.connect(options["database"], **({"timeout": 120} if module.__name__ == "sqlite3" else {}))


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _names(text: str) -> list[str]:
    return [x.strip() for x in text.split(",") if x.strip()]


@dataclass
class KeyRange(InputPartition):
    low: int | None
    high: int | None  # excluded; neither: the rows with a null key


class ServingReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.columns, self.options = [f.name for f in schema], options

    def partitions(self) -> list[KeyRange]:
        o, key = self.options, _quoted(self.options["key"])
        con = _connect(o)
        low, high, nulls = con.execute(f"SELECT MIN({key}), MAX({key}), COUNT(*) - COUNT({key}) FROM {_quoted(o['table'])}").fetchone()
        con.close()
        out = [KeyRange(None, None)] if nulls else []
        if low is not None:
            step = -(-(high - low + 1) // int(o.get("partitions", "8")))
            out += [KeyRange(at, min(at + step, high + 1)) for at in range(low, high + 1, step)]
        return out or [KeyRange(0, 0)]

    def read(self, partition: KeyRange) -> Iterator[tuple]:
        o, key = self.options, _quoted(self.options["key"])
        con = _connect(o)
        where, told = (f"{key} IS NULL", ()) if partition.low is None else (f"{key} >= ? AND {key} < ?", (partition.low, partition.high))
        cursor = con.execute(f"SELECT {', '.join(map(_quoted, self.columns))} FROM {_quoted(o['table'])} WHERE {where}", told)
        while rows := cursor.fetchmany(int(o.get("batch", "2000"))):
            yield from map(tuple, rows)
        con.close()


@dataclass
class Staged(WriterCommitMessage):
    attempt: str
    rows: int


class ServingWriter(DataSourceWriter):
    """Two phases: every task puts its rows into a staging table under a name of its attempt; when all have, one transaction upserts those of the attempts that count.

    A task that fails leaves rows that nothing counts; they go with the staging table.  A job that fails leaves the table as it was.
    """

    def __init__(self, schema: StructType, options: dict[str, str], overwrite: bool):
        self.columns, self.options, self.overwrite = [f.name for f in schema], options, overwrite
        self.keys, self.kept = _names(options["key"]), _names(options.get("preserve", ""))
        self.stage = f"_stage_{uuid.uuid4().hex}"
        kinds = {"long": "INTEGER", "integer": "INTEGER", "short": "INTEGER", "byte": "INTEGER", "boolean": "INTEGER", "double": "DOUBLE PRECISION", "float": "DOUBLE PRECISION"}
        defined = ", ".join(f"{_quoted(f.name)} {kinds.get(f.dataType.typeName(), 'TEXT')}" for f in schema)
        con = _connect(options)
        with con:
            con.execute(f"CREATE TABLE IF NOT EXISTS {_quoted(options['table'])} ({defined}, PRIMARY KEY ({', '.join(map(_quoted, self.keys))}))")
            con.execute(f"CREATE TABLE {self.stage} (_attempt TEXT, {defined})")
        con.close()

    def write(self, iterator: Iterator[Row]) -> Staged:
        task = TaskContext.get()
        attempt, n, size = f"{task.partitionId()}-{task.taskAttemptId()}", 0, int(self.options.get("batch", "2000"))
        con = _connect(self.options)
        put = f"INSERT INTO {self.stage} VALUES ({', '.join('?' * (len(self.columns) + 1))})"
        held: list[tuple] = []
        for row in iterator:
            held.append((attempt, *row))
            if len(held) >= size:
                with con:
                    con.executemany(put, held)
                n, held = n + len(held), []
        with con:
            con.executemany(put, held)
        con.close()
        return Staged(attempt, n + len(held))

    def commit(self, messages: list[Staged | None]) -> None:
        names = [*map(_quoted, self.columns)]
        updates = [f"{_quoted(c)} = excluded.{_quoted(c)}" for c in self.columns if c not in (*self.keys, *self.kept)]
        then = f"DO UPDATE SET {', '.join(updates)}" if updates else "DO NOTHING"
        con = _connect(self.options)
        with con:  # one transaction
            if self.overwrite:
                con.execute(f"DELETE FROM {_quoted(self.options['table'])}")
            for m in filter(None, messages):
                con.execute(f"INSERT INTO {_quoted(self.options['table'])} ({', '.join(names)}) SELECT {', '.join(names)} FROM {self.stage} WHERE _attempt = ? ON CONFLICT ({', '.join(map(_quoted, self.keys))}) {then}", (m.attempt,))
            con.execute(f"DROP TABLE {self.stage}")
        con.close()

    def abort(self, messages: list[Staged | None]) -> None:
        con = _connect(self.options)
        with con:
            con.execute(f"DROP TABLE IF EXISTS {self.stage}")
        con.close()


class Serving(DataSource):
    @classmethod
    def name(cls) -> str:
        return "serving"

    def schema(self) -> StructType:
        """From the declared types of the table: whole numbers, numbers, else text."""
        con = _connect(self.options)
        kinds = con.execute(f"SELECT name, type FROM pragma_table_info('{self.options['table'].replace(chr(39), chr(39) * 2)}')").fetchall()
        con.close()
        kind = lambda t: LongType() if "INT" in t.upper() else DoubleType() if any(x in t.upper() for x in ("DOUB", "REAL", "FLOA")) else StringType()
        return StructType([StructField(n, kind(t)) for n, t in kinds])

    def reader(self, schema: StructType) -> ServingReader:
        return ServingReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> ServingWriter:
        return ServingWriter(schema, dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Serving)
