"""Robots rules and sitemaps."""

from __future__ import annotations

import gzip
import io
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import trim_all_ends
from .tables import work_dir

#: Whatever ends a line of a robots file.
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def robots(files: DataFrame) -> DataFrame:
    """host, kind (sitemap, disallow, allow), value, line of every robots file (host, text).

    Rules count in groups that name the agent ``*``.  A group begins with an
    agent that follows any other directive, known or not; directives before
    the first agent belong to none.  Sitemap lines always count.
    """
    lines = files.select("host", F.posexplode(F.split("text", _LINE_END)).alias("line", "raw"))
    bare = F.regexp_replace("raw", "#.*", "")
    parts = lines.select("host", "line", F.lower(trim_all_ends(F.substring_index(bare, ":", 1))).alias("field"), trim_all_ends(F.substr(bare, F.instr(bare, ":") + 1)).alias("value")).where(bare.contains(":"))
    order = Window.partitionBy("host").orderBy("line")
    opens = (F.col("field") == "user-agent") & (F.coalesce(F.lag("field").over(order), F.lit("rule")) != "user-agent")
    grouped = parts.withColumn("opens", opens.cast("int")).withColumn("block", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    named = grouped.withColumn("all", F.max(F.expr("field = 'user-agent' AND value = '*'")).over(Window.partitionBy("host", "block")))
    rules = named.where("field IN ('disallow', 'allow') AND all AND value <> ''").select("host", F.col("field").alias("kind"), "value", "line")
    maps = named.where("field = 'sitemap' AND value <> ''").select("host", F.col("field").alias("kind"), "value", "line")
    return rules.unionByName(maps)


def sitemap_locations(files: DataFrame) -> DataFrame:
    """name, root (urlset or sitemapindex), loc of every entry of sitemaps (name, content), plain or gzip.

    Only ``loc`` directly below ``url`` or ``sitemap`` counts; each file is read as a stream; a file that
    is no XML has no rows.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                own: list[tuple[str, str, str]] = []
                try:
                    raw = io.BytesIO(content)
                    stream = gzip.open(raw) if content[:2] == b"\x1f\x8b" else raw
                    stack: list[str] = []
                    for event, e in ET.iterparse(stream, ("start", "end")):
                        tag = e.tag.rpartition("}")[2]
                        if event == "start":
                            stack.append(tag)
                            continue
                        stack.pop()
                        if tag == "loc" and stack and stack[-1] in ("url", "sitemap") and (e.text or "").strip():
                            own.append((name, stack[0], e.text.strip()))
                        elif tag in ("url", "sitemap"):
                            e.clear()
                except (ET.ParseError, OSError, EOFError):
                    own = []
                rows += own
            yield pd.DataFrame(rows, columns=["name", "root", "loc"])

    return files.select("name", "content").mapInPandas(read, "name string, root string, loc string")


def reachable(spark: SparkSession, links: DataFrame, roots: DataFrame) -> DataFrame:
    """url, depth of everything that the links (parent, child) lead to from the roots (url); each once, at its least depth.

    Each round follows the links from what the last one found and keeps what no round
    has found before, until nothing is new: cycles and many ways to one url cost nothing.
    """
    root, depth = f"{work_dir(spark)}/walk-{uuid.uuid4().hex[:12]}", 0
    seen = lambda: spark.read.schema("url string, depth int").parquet(root)
    found = roots.select(F.col("url").cast("string"))
    while True:
        found.where("url IS NOT NULL").distinct().write.parquet(f"{root}/depth={depth}")
        last = spark.read.schema("url string").parquet(f"{root}/depth={depth}")
        if last.isEmpty():
            return seen()
        found = links.join(last, links["parent"] == last["url"]).select(F.col("child").cast("string").alias("url")).distinct().join(seen().select("url"), "url", "left_anti")
        depth += 1
