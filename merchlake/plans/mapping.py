"""Field mapping: what each canonical field is, declared for each source, compiled to columns.

A field's spec has one of these keys: ``path`` (a column, dotted names
allowed), ``formula`` (Spark SQL, which may use canonical fields mapped
before it), ``static`` (a literal) or ``none``.  ``unit: minor`` turns
hundredths into whole units for paths and formulas.  Anything else is an error.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import minor_to_major
from ..schemas import MAPPED
from ..sources.records import quoted

Spec = Mapping[str, Any]
STRATEGIES = ("path", "formula", "static", "none")


def compile_field(spec: Spec) -> Column:
    kind = [s for s in STRATEGIES if s in spec]
    if len(kind) != 1:
        raise ValueError(f"a field has one of {STRATEGIES}: {dict(spec)}")
    if kind[0] == "static":
        return F.lit(spec["static"])
    if kind[0] == "none":
        return F.lit(None)
    value = F.col(quoted(spec["path"])) if kind[0] == "path" else F.expr(spec["formula"])
    return minor_to_major(value) if spec.get("unit") == "minor" else value


def map_source(df: DataFrame, site: str, fields: Mapping[str, Spec], schema: Mapping[str, str] = MAPPED, keep: tuple[str, ...] = ()) -> DataFrame:
    """site_code, the canonical fields in order, and the columns of keep.

    Fields are mapped one after the other, so that a formula sees what was
    mapped before it; a source column of the same name comes first.  Fields
    without a spec are null.
    """
    if "id" not in fields:
        raise ValueError(f"{site}: the field id is not mapped")
    unknown = set(fields) - set(schema)
    if unknown:
        raise ValueError(f"{site}: unknown fields {sorted(unknown)}")
    own, made = set(df.columns), {}
    for name in [*fields, *(c for c in schema if c not in fields)]:
        column = compile_field(fields.get(name, {"none": True})).cast(schema[name])
        # mapped values wait under a name of their own while source columns may still be read
        made[name] = f"_mapped_{name}"
        df = df.withColumn(made[name], column)
        if name not in own:
            df = df.withColumn(name, F.col(made[name]))
    return df.select(F.lit(site).alias("site_code"), *(F.col(made[c]).alias(c) for c in schema), *(F.col(quoted(k)) for k in keep))


def map_sources(sources: Mapping[str, tuple[DataFrame, Mapping[str, Spec]]], keep: tuple[str, ...] = ()) -> tuple[DataFrame | None, dict[str, Exception]]:
    """The union of all sources that compile, and the errors of those that do not."""
    out, errors = None, {}
    for site, (df, fields) in sources.items():
        try:
            mapped = map_source(df, site, fields, keep=keep)
            _ = mapped.schema  # analysis finds unknown columns without a job
        except Exception as e:
            errors[site] = e
            continue
        out = mapped if out is None else out.unionByName(mapped)
    return out, errors


#: The strategies' names in mapping files, and the names of hundredths.
FILE_STRATEGIES = {"direct_path": "path", "computed": "formula", "static": "static", "none": "none"}
MINOR_UNITS = ("minor", "kurus")


def spec_of(entry: Mapping[str, Any]) -> Spec:
    """A field's spec from a mapping file: as here, or with its strategy by name."""
    if "strategy" not in entry:
        return entry
    kind = FILE_STRATEGIES.get(entry["strategy"])
    if kind is None:
        raise ValueError(f"a strategy is one of {sorted(FILE_STRATEGIES)}: {entry['strategy']}")
    if kind == "none":
        return {"none": True}
    value = entry.get(kind, entry.get("value"))
    return {kind: value} | ({"unit": "minor"} if entry.get("unit") in MINOR_UNITS else {})


def mapping_files(spark: SparkSession, folder: str, key: str = "field_mapping", endings: tuple[str, ...] = ("json", "yaml", "yml")) -> dict[str, dict[str, Spec]]:
    """The mappings in a folder of JSON or YAML files, by file name without its ending; files without the key are no sources.

    Only .yaml and .yml files are YAML.  Files are read through Spark, so the folder may be in any store; YAML needs the package yaml.
    """
    found = {}
    for name, text in sorted(spark.read.text(folder, wholetext=True, pathGlobFilter="*.{" + ",".join(endings) + "}").select(F.input_file_name(), "value").collect()):
        if name.endswith((".yaml", ".yml")):
            import yaml

            config = yaml.safe_load(text)
        else:
            config = json.loads(text)
        if config and config.get(key):
            found[name.rpartition("/")[2].rpartition(".")[0]] = {field: spec_of(e or {"none": True}) for field, e in config[key].items()}
    return found
