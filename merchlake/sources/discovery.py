"""Categories found in page addresses: by the tree of their segments, or by a pattern."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def segments(url: Column) -> Column:
    """The parts of an address's path, without query and fragment; empty ones are left out."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*\z", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    return F.array_remove(F.split(path, "/", -1), "")


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def prefix_tree(urls: DataFrame, url: str = "url") -> DataFrame:
    """host, prefix, depth, children, pages: every prefix of a path, how many different segments follow it and how many addresses lie at or below it.

    Equal addresses count once.  Counts are taken in two steps, by prefix and
    child and then by prefix, so that tasks combine what they have before the shuffle: the root of a large host is no hot key.
    """
    c = F.col(url)
    pages = urls.select(host(c).alias("host"), segments(c).alias("s")).where("host IS NOT NULL").distinct()
    cut = pages.select("host", "s", F.explode(F.sequence(F.lit(0), F.size("s"))).alias("depth"))
    steps = cut.select("host", F.array_join(F.slice("s", F.lit(1), F.col("depth")), "/").alias("prefix"), "depth", F.get("s", F.col("depth")).alias("child"))
    by_child = steps.groupBy("host", "prefix", "depth", "child").agg(F.count(F.lit(1)).alias("n"))
    return by_child.groupBy("host", "prefix", "depth").agg(F.count("child").alias("children"), F.sum("n").alias("pages"))


def categories(urls: DataFrame, url: str = "url", depths: tuple[int, int] = (1, 3), least_children: int = 3, leaves_only: bool = True) -> DataFrame:
    """The prefixes between two depths with enough different children; with leaves_only those that no deeper category lies under."""
    found = prefix_tree(urls, url).where(F.col("depth").between(*depths) & (F.col("children") >= least_children))
    if not leaves_only:
        return found
    parts = F.split("prefix", "/", -1)
    above = found.where("depth > 1").select("host", F.explode(F.transform(F.sequence(F.lit(1), F.col("depth") - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).alias("prefix")).distinct()
    return found.join(above, ["host", "prefix"], "left_anti")


def matching(urls: DataFrame, pattern: str, names: Sequence[str], url: str = "url", least_pages: int = 1) -> DataFrame:
    """host, the groups of a pattern under their names, and pages, the number of different addresses that it finds; addresses it does not find are no categories."""
    c = F.col(url)
    found = urls.where(c.rlike(pattern)).select(host(c).alias("host"), *(F.regexp_extract(c, pattern, i + 1).alias(n) for i, n in enumerate(names)), c.alias("_url")).distinct()
    return found.groupBy("host", *names).agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least_pages)
