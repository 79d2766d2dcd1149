"""Pages, robots files and sitemaps as table functions of SQL: ``SELECT ... FROM pages, LATERAL robots_rules(text)``.

Each reads one document and gives its rows.  The DataFrame forms in ``web`` and
``records`` do the same for whole columns and are the faster ones; these are for queries
that are written in SQL.
"""

from __future__ import annotations

import gzip
import html
import io
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Directives that robots_rules tells.
RULES = ("disallow", "allow")


class RobotsRules:
    """kind, value, line of the rules for all agents and of the sitemaps in a robots file."""

    def eval(self, text: str) -> Iterator[tuple[str, str, int]]:
        everyone = open_group = False
        for n, raw in enumerate((text or "").splitlines()):
            field, colon, value = (x.strip() for x in raw.split("#", 1)[0].partition(":"))
            field = field.lower()
            if not colon:
                continue
            if field == "user-agent":
                everyone = value == "*" or everyone and open_group
                open_group = True
                continue
            open_group = False
            if value and (field == "sitemap" or everyone and field in RULES):
                yield field, value, n


class SitemapEntries:
    """root, loc of every entry of a sitemap, plain or gzip; none for what is no XML."""

    def eval(self, content: bytes) -> Iterator[tuple[str, str]]:
        try:
            raw = gzip.decompress(content) if content and content[:2] == b"\x1f\x8b" else content or b""
            root = ET.parse(io.BytesIO(raw)).getroot()
        except (ET.ParseError, OSError, EOFError):
            return
        name = lambda e: e.tag.rpartition("}")[2]
        for entry in root:
            for loc in entry if name(entry) in ("url", "sitemap") else ():
                if name(loc) == "loc" and (loc.text or "").strip():
                    yield name(root), loc.text.strip()


class EmbeddedRecords:
    """pos and the fields of every record in the JSON blocks that a pattern's first group finds in a page, fields as text.

    The fields are a constant argument, names with commas between them: the columns of the result follow from it.
    """

    @staticmethod
    def analyze(page: AnalyzeArgument, pattern: AnalyzeArgument, fields: AnalyzeArgument) -> AnalyzeResult:
        if fields.value is None:
            raise ValueError("the fields of embedded_records are a constant, such as 'id,name'")
        names = [f.strip() for f in fields.value.split(",")]
        return AnalyzeResult(StructType([StructField("pos", IntegerType()), *(StructField(f, StringType()) for f in names)]))

    def eval(self, page: str, pattern: str, fields: str) -> Iterator[tuple]:
        names, pos = [f.strip() for f in fields.split(",")], 0
        for block in re.findall(pattern, page or ""):
            try:
                found = json.loads(html.unescape(block if isinstance(block, str) else block[0]))
            except ValueError:
                continue
            for record in found if isinstance(found, list) else [found]:
                if isinstance(record, dict):
                    told = (record.get(f) for f in names)
                    yield (pos, *(x if x is None or isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in told))
                    pos += 1


def register(spark: SparkSession) -> None:
    """Make robots_rules, sitemap_entries and embedded_records known to SQL for the session."""
    spark.udtf.register("robots_rules", udtf(RobotsRules, returnType="kind string, value string, line int"))
    spark.udtf.register("sitemap_entries", udtf(SitemapEntries, returnType="root string, loc string"))
    spark.udtf.register("embedded_records", udtf(EmbeddedRecords))
