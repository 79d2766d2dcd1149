"""Records from JSON and XML documents: sniffing, items, flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def parse(text: Column, schema: str) -> Column:
    """A document as a struct: XML if its first character, white space aside, says so, else JSON; null fields where it is malformed."""
    return F.when(is_xml(text), F.from_xml(text, schema)).otherwise(F.from_json(text, schema))


def is_xml(text: Column) -> Column:
    return text.rlike(r"\A\s*<")


def is_malformed(text: Column) -> Column:
    """True for JSON or XML that does not parse."""
    broken = F.from_xml(F.when(is_xml(text), text), "_broken string", {"columnNameOfCorruptRecord": "_broken"})["_broken"].isNotNull()
    return text.isNotNull() & F.when(is_xml(text), broken).otherwise(F.try_parse_json(text).isNull())


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the schema that all their rows have together."""
    return spark.read.json(path)


def items(df: DataFrame, document: Column, path: str) -> DataFrame:
    """One row for each record in the list at a dotted path, as column item; nulls in the list are dropped."""
    for step in path.split("."):
        document = document[step]
    return df.withColumn("item", F.explode(document)).where("item IS NOT NULL")


def _leaves(kind: DataType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
    if isinstance(kind, StructType):
        return [leaf for f in kind.fields for leaf in _leaves(f.dataType, (*path, f.name))]
    return [path]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def flatten(df: DataFrame) -> DataFrame:
    """Structs become columns with dotted names, at any depth; lists stay."""
    out = []
    for f in df.schema.fields:
        for leaf in _leaves(f.dataType, (f.name,)):
            out.append(F.col(".".join(map(quoted, leaf))).alias(".".join(leaf)))
    return df.select(*out)


def drop_prefixes(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(quoted(c)) for c in df.columns if not c.startswith(tuple(prefixes)))) if prefixes else df


def whitelist(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(quoted(c)) for c in columns))


def embedded_json(html: Column, pattern: str, schema: str) -> Column:
    """The records in JSON blocks that a pattern's first group finds in a page; lists are opened, bad blocks skipped."""
    from ..functions.text import unescape

    blocks = F.split(unescape(F.array_join(F.regexp_extract_all(html, F.lit(pattern), 1), "\x00")), "\x00", -1)
    lists = F.transform(blocks, lambda b: F.from_json(F.when(F.startswith(F.ltrim(b), F.lit("[")), b).otherwise(F.concat(F.lit("["), b, F.lit("]"))), f"array<{schema}>"))
    return F.filter(F.flatten(F.filter(lists, lambda x: x.isNotNull())), lambda x: x.isNotNull())
