"""Sites by configuration: each is a name and what its records need on the way to the history.

A site that cannot be built (an unknown column, a mapping without id) is told
and left out; rows that fail are told by ``quarantine``.  The others go on.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.records import drop_prefixes, flatten
from . import history
from .mapping import Spec, spec_of
from .quarantine import map_apart


@dataclass(frozen=True)
class Site:
    """name; product: the column with a record's product id; columns: those approved (all, if none); prefixes: columns to drop by the beginning of their names; drop, add: overrides of approved columns."""

    name: str
    fields: Mapping[str, Spec]
    product: str
    columns: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    add: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, name: str, config: Mapping[str, Any]) -> Site:
        """From a configuration: field_mapping, product_id_field and, where there are any, columns, drop_prefixes, drop, add."""
        fields = {k: spec_of(e or {"none": True}) | ({"required": True} if (e or {}).get("required") else {}) for k, e in config["field_mapping"].items()}
        lists = {k: tuple(config.get(c, ())) for k, c in (("columns", "columns"), ("prefixes", "drop_prefixes"), ("drop", "drop"))}
        return cls(name, fields, config["product_id_field"], **lists, add=dict(config.get("add", {})))


def sites(spark: SparkSession, folder: str) -> dict[str, Site]:
    """The sites that JSON files in a folder configure, by file name; files without a field_mapping are no sites."""
    out = {}
    for path, text in sorted(spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select(F.input_file_name(), "value").collect()):
        config, name = json.loads(text), path.rpartition("/")[2].removesuffix(".json")
        if config.get("field_mapping"):
            out[name] = Site.of(name, config)
    return out


def build(found: Mapping[str, Site], raw: Mapping[str, DataFrame], run: str = "_ingested_at", row_id: str = "_row_id") -> tuple[DataFrame | None, DataFrame | None, dict[str, Exception]]:
    """The canonical rows of all sites that have raw records, the errors of their rows, and the sites that could not be built.

    raw: each site's records with run and row_id; the first of each product and run counts.
    """
    good = bad = None
    failed: dict[str, Exception] = {}
    for name in [n for n in found if n in raw]:
        site = found[name]
        try:
            records = drop_prefixes(flatten(raw[name]), site.prefixes)
            columns = [*dict.fromkeys((*(site.columns or records.columns), site.product, run, row_id))]
            own = history.clean(records, columns, site.product, run, row_id, site.drop, site.add)
            mapped, errors = map_apart(own, name, site.fields, keep=(run,))
            mapped = history.normalise(mapped, run)
        except Exception as e:  # analysis only: no job has run
            failed[name] = e
            continue
        good, bad = (mapped, errors) if good is None else (good.unionByName(mapped), bad.unionByName(errors))
    return good, bad, failed
