"""Records whose schema nobody wrote down: JSON and XML documents of any shape.

Each document is parsed to a VARIANT, whose shape Spark tells as text.  Every
task merges the shapes of its documents to one, the driver merges those (one for each
task), and the documents are read again with the schema that all of them have together.

What differs is widened: whole numbers and fractions to fractions, a null to the
other, fields of objects are joined.  A field that is a list in one XML
document and single or missing in others is a list: that is how XML writes
lists.  Anything else that differs is text, JSON where it was a list or an object.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .records import is_malformed, is_xml

#: Elements only: no attributes, no prefixes.
XML = {"excludeAttribute": "true", "ignoreNamespace": "true"}
_TOKEN = re.compile(r"`(?:[^`]|``)*`|[A-Za-z0-9_]+(?:\([^)]*\))?|[<>:,]|\S")

# A shape is a type's name, ["list", shape] or ["object", {field: shape}].
Shape = str | list


def shape_of(text: str) -> Shape:
    """The shape that schema_of_variant tells."""
    tokens = _TOKEN.findall(text)
    at = 0

    def take() -> str:
        nonlocal at
        at += 1
        return tokens[at - 1]

    def one() -> Shape:
        name = take().upper()
        if name == "ARRAY":
            take()
            inner = one()
            take()
            return ["list", inner]
        if name == "OBJECT":
            fields = {}
            take()
            while tokens[at] != ">":
                field = take()
                take()
                fields[field[1:-1].replace("``", "`") if field[0] == "`" else field] = one()
                if tokens[at] == ",":
                    take()
            take()
            return ["object", fields]
        return "DOUBLE" if name.startswith(("DECIMAL", "FLOAT")) else name

    return one()


def merge(a: Shape, b: Shape, lists: bool) -> Shape:
    """The shape that holds both; lists: a list and what may stand in it are a list."""
    if a == b or b == "VOID":
        return a
    if a == "VOID":
        return b
    kinds = [x[0] if isinstance(x, list) else x for x in (a, b)]
    if kinds == ["object", "object"]:
        return ["object", {k: merge(a[1].get(k, "VOID"), b[1].get(k, "VOID"), lists) for k in (*a[1], *(k for k in b[1] if k not in a[1]))}]
    if kinds == ["list", "list"]:
        return ["list", merge(a[1], b[1], lists)]
    if lists and "list" in kinds:
        return ["list", merge(a[1], b, lists) if kinds[0] == "list" else merge(a, b[1], lists)]
    return "DOUBLE" if set(kinds) == {"BIGINT", "DOUBLE"} else "STRING"


def ddl(shape: Shape) -> str:
    """The shape as a type in SQL; fields in the order of their names, what is null everywhere as text."""
    if isinstance(shape, str):
        return {"VOID": "STRING", "UUID": "STRING"}.get(shape, shape)
    if shape[0] == "list":
        return f"ARRAY<{ddl(shape[1])}>"
    fields = ", ".join(f"`{k.replace('`', '``')}`: {ddl(v)}" for k, v in sorted(shape[1].items()))
    return f"STRUCT<{fields}>" if fields else "STRING"


def variant(text: Column, kind: str = "any") -> Column:
    """A document as a VARIANT; null where it is malformed. kind: json, xml, or any, where each document shows which it is."""
    if kind == "json":
        return F.try_parse_json(text)
    # a document that ends early is no error to from_xml with a VARIANT: its rest is looked at by the schema-less check
    found = F.when(~is_malformed(F.when(is_xml(text), text)), F.from_xml(F.when(is_xml(text), text), "variant", XML))
    return found if kind == "xml" else F.when(is_xml(text), found).otherwise(F.try_parse_json(F.when(~is_xml(text), text)))


def infer(df: DataFrame, text: Column, kind: str = "any") -> str | None:
    """The type, in SQL, that all well-formed documents have together; None if there are none. One pass over all rows."""
    told = df.select(F.schema_of_variant(variant(text, kind)).alias("shape"), F.lit(kind == "xml") if kind != "any" else is_xml(text).alias("xml")).toDF("shape", "xml").where("shape IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, bool]] = set()
        whole: dict[bool, Shape] = {}
        for b in batches:
            for pair in set(zip(b.column("shape").to_pylist(), b.column("xml").to_pylist(), strict=True)) - seen:
                if len(seen) < 10_000:  # merging one again is harmless
                    seen.add(pair)
                whole[pair[1]] = merge(whole.get(pair[1], "VOID"), shape_of(pair[0]), pair[1])
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(s) for s in whole.values()], pa.string()), pa.array([*whole], pa.bool_())], ["shape", "xml"])

    whole: dict[bool, Shape] = {}
    for r in told.mapInArrow(run, "shape string, xml boolean").collect():  # one or two rows for each task
        whole[r.xml] = merge(whole.get(r.xml, "VOID"), json.loads(r["shape"]), r.xml)
    if not whole:
        return None
    both = merge(whole.get(False, "VOID"), whole.get(True, "VOID"), True)
    return ddl(both)


def parsed(df: DataFrame, text: str, name: str = "document", kind: str = "any") -> DataFrame:
    """df with its documents as structs of one inferred type; null where they are malformed, text where no type is found."""
    c = F.col(text)
    found = infer(df, c, kind)
    if found is None or not found.startswith("STRUCT"):
        return df.withColumn(name, F.when(~is_malformed(c), c))
    read = {"json": F.from_json(c, found), "xml": F.from_xml(c, found, XML)}
    own = read.get(kind, F.when(is_xml(c), F.from_xml(F.when(is_xml(c), c), found, XML)).otherwise(F.from_json(F.when(~is_xml(c), c), found)))
    return df.withColumn(name, F.when(~is_malformed(c), own))
