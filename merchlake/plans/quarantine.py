"""Mappings that no bad row can stop: what fails is null, and told in a table of errors.

Under ANSI rules one value that cannot be cast, one division by zero or one
index beyond a list ends the job of all sources.  Here formulas are resolved
under the rules that give null instead, fields are cast by ``try_cast``, and
beside the mapped rows there is a row for every field of a record that failed:

* ``cast``: a value that is not null and is none of the field's type, or of the type that a CAST in the formula names;
* ``null``: a field that the mapping calls ``required`` and that came out null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import minor_to_major
from ..schemas import MAPPED
from ..sources.records import quoted
from .mapping import STRATEGIES, Spec

#: The errors of one record: field, reason, value (as text).
ERRORS = "array<struct<field: string, reason: string, value: string>>"


@contextmanager
def null_on_error(spark: SparkSession) -> Iterator[None]:
    """What is resolved meanwhile gives null where ANSI rules raise an error."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def casts(formula: str) -> list[tuple[str, str]]:
    """The argument and the type of every CAST in a formula, inner ones too; those within quotes do not count."""
    bare = re.sub(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"", lambda m: "\0" * len(m[0]), formula)
    found = []
    for m in re.finditer(r"(?i)\bCAST\s*\(", bare):
        depth, at = 1, m.end()
        while at < len(bare) and depth:
            depth += {"(": 1, ")": -1}.get(bare[at], 0)
            at += 1
        inside, text = bare[m.end() : at - 1], formula[m.end() : at - 1]
        level = 0  # the AS that is not within brackets
        for word in re.finditer(r"\(|\)|(?i:\bAS\b)", inside):
            level += {"(": 1, ")": -1}.get(word[0], 0)
            if not level and word[0].upper() == "AS":
                found.append((text[: word.start()].strip(), text[word.end() :].strip()))
                break
    return found


def map_apart(df: DataFrame, site: str, fields: Mapping[str, Spec], schema: Mapping[str, str] = MAPPED, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The mapped rows, as ``map_source`` gives them but with nulls where a field failed, and the errors: site_code, id, field, reason, value.

    A formula sees the fields before it, nulls where those failed.  What is
    wrong with the mapping itself (unknown columns, no id) is still an error at once.
    """
    if "id" not in fields or set(fields) - set(schema):
        raise ValueError(f"{site}: the field id is not mapped, or one is unknown")
    spark, own, made, told = df.sparkSession, set(df.columns), {}, []
    with null_on_error(spark):
        for name in [*fields, *(c for c in schema if c not in fields)]:
            spec = fields.get(name, {"none": True})
            kind = [s for s in STRATEGIES if s in spec]
            if len(kind) != 1:
                raise ValueError(f"a field has one of {STRATEGIES}: {dict(spec)}")
            value = {"static": lambda s: F.lit(s["static"]), "none": lambda s: F.lit(None), "path": lambda s: F.col(quoted(s["path"])), "formula": lambda s: F.expr(s["formula"])}[kind[0]](spec)
            raw, out, errors = f"_raw_{name}", f"_mapped_{name}", f"_errors_{name}"
            df = df.withColumn(raw, minor_to_major(value.try_cast("double")) if spec.get("unit") == "minor" and kind[0] in ("path", "formula") else value)
            df = df.withColumn(out, F.col(raw).try_cast(schema[name]) if df.schema[raw].dataType.simpleString() != "void" else F.lit(None).cast(schema[name]))
            failed: list[tuple[Column, str, Column]] = [(F.col(raw).isNotNull() & F.col(out).isNull(), "cast", F.col(raw).cast("string"))]
            if spec.get("unit") == "minor" and kind[0] == "path":
                failed.append((value.isNotNull() & value.try_cast("double").isNull(), "cast", value.cast("string")))
            for text, type_ in casts(spec["formula"]) if kind[0] == "formula" else ():
                failed.append((F.expr(f"({text}) IS NOT NULL AND TRY_CAST(({text}) AS {type_}) IS NULL"), "cast", F.expr(f"CAST(({text}) AS STRING)")))
            if spec.get("required"):
                failed.append((F.col(out).isNull(), "null", F.lit(None).cast("string")))
            rows = F.array(*(F.when(c, F.struct(F.lit(name).alias("field"), F.lit(reason).alias("reason"), v.alias("value"))) for c, reason, v in failed))
            df = df.withColumn(errors, F.array_distinct(F.filter(rows, lambda x: x.isNotNull())))
            made[name] = out
            told.append(errors)
            if name not in own:
                df = df.withColumn(name, F.col(out))
    good = df.select(F.lit(site).alias("site_code"), *(F.col(made[c]).alias(c) for c in schema), *(F.col(quoted(k)) for k in keep))
    bad = df.select(F.lit(site).alias("site_code"), F.col(made["id"]).alias("id"), F.inline(F.flatten(F.array(*told)).cast(ERRORS)))
    return good, bad
