"""Price drops: in-stock products whose price fell since their previous in-stock observation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import effective_price


def percent_drop(old: Column, new: Column) -> Column:
    return (old - new) / F.nullif(old, F.lit(0.0)) * 100


def price_drops(history: DataFrame, keys: Sequence[str], when: str, ties: Sequence[str] = (), threshold: float = 10.0, alerted: DataFrame | None = None, alert_keys: Sequence[str] = ()) -> DataFrame:
    """keys, when, old_eff, new_eff, pct_drop (one decimal), and the sale and conditional prices, old and new.

    history has sale, conditional, in_stock.  One shuffle by the keys serves
    both windows: the newest run over all rows, then the rank and the previous
    price over the rows in stock.  A drop counts if the newest row of all is
    in stock; it is left out if its alert_keys are in alerted.
    """
    product = Window.partitionBy(*keys)
    order = product.orderBy(F.desc(when), *(F.desc(t) for t in ties))
    eff = effective_price(F.col("sale"), F.col("conditional"))
    seen = history.withColumn("_newest", F.max(when).over(product)).where(F.col("in_stock").eqNullSafe(True) & F.col("sale").isNotNull())
    ranked = seen.withColumns({"_rn": F.row_number().over(order), "new_eff": eff, "old_eff": F.lead(eff).over(order), "old_sale": F.lead("sale").over(order), "old_conditional": F.lead("conditional").over(order)})
    drops = ranked.where((F.col("_rn") == 1) & (F.col(when) == F.col("_newest")) & (F.col("new_eff") < F.col("old_eff")) & (percent_drop(F.col("old_eff"), F.col("new_eff")) >= threshold))
    if alerted is not None:
        drops = drops.join(alerted, [*alert_keys], "left_anti")
    return drops.withColumn("pct_drop", F.round(percent_drop(F.col("old_eff"), F.col("new_eff")).cast("decimal(20,8)"), 1).cast("double")).drop("_rn", "_newest")


def price_drops_by_joins(history: DataFrame, keys: Sequence[str], when: str, ties: Sequence[str] = (), threshold: float = 10.0, alerted: DataFrame | None = None, alert_keys: Sequence[str] = ()) -> DataFrame:
    """The same answer the long way: a self-join of ranks, and a join to the newest run. Kept as a check of the other."""
    order = Window.partitionBy(*keys).orderBy(F.desc(when), *(F.desc(t) for t in ties))
    eff = effective_price(F.col("sale"), F.col("conditional"))
    ranked = history.where(F.col("in_stock").eqNullSafe(True) & F.col("sale").isNotNull()).withColumns({"_rn": F.row_number().over(order), "_eff": eff})
    newest = history.groupBy(*keys).agg(F.max(when).alias("_newest"))
    last = ranked.where("_rn = 1").withColumnRenamed("_eff", "new_eff")
    before = ranked.where("_rn = 2").select(*keys, F.col("_eff").alias("old_eff"), F.col("sale").alias("old_sale"), F.col("conditional").alias("old_conditional"))
    drops = last.join(before, [*keys]).join(newest, [*keys]).where((F.col(when) == F.col("_newest")) & (F.col("new_eff") < F.col("old_eff")) & (percent_drop(F.col("old_eff"), F.col("new_eff")) >= threshold))
    if alerted is not None:
        drops = drops.join(alerted, [*alert_keys], "left_anti")
    return drops.withColumn("pct_drop", F.round(percent_drop(F.col("old_eff"), F.col("new_eff")).cast("decimal(20,8)"), 1).cast("double")).drop("_rn", "_newest")


def mass_events(drops: DataFrame, group: str, more_than: int = 50) -> DataFrame:
    """Adds kind: summary for drops of a group with more than that many, else individual. Groups are counted where the rows are."""
    large = drops.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than)
    return drops.join(large, F.col(group).eqNullSafe(F.col("_group")), "left").withColumn("kind", F.when(F.col("_n").isNotNull(), "summary").otherwise("individual")).drop("_group", "_n")


def report(drops: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The drops, the largest first, equal ones by their keys."""
    return drops.orderBy(F.desc("pct_drop"), *keys)


def mass_summaries(drops: DataFrame, group: str, more_than: int = 50) -> DataFrame:
    found = drops.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg("pct_drop").alias("avg_drop"), F.max("pct_drop").alias("max_drop"))
    return found.where(F.col("n") > more_than)


def shown_and_rest(drops: DataFrame, order: Sequence[Column], limit: int = 30) -> tuple[DataFrame, DataFrame]:
    """The first rows of a report, and a row with how many are not shown."""
    shown = drops.orderBy(*order).limit(limit)
    rest = drops.agg(F.greatest(F.count(F.lit(1)) - limit, F.lit(0)).alias("more"))
    return shown, rest


def escape_html(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def caption(site: Column, name: Column, brand: Column, old_sale: Column, new_sale: Column, old_cond: Column, new_cond: Column, pct: Column, url: Column) -> Column:
    """The message on a drop, lines joined by line feeds; the member price only where it is the lower one."""
    money = lambda c: F.format_string("%.2f TL", c)
    change = lambda a, b: F.concat(F.lit("<s>"), money(a), F.lit("</s> → <b>"), money(b), F.lit("</b>"))
    member = new_cond.isNotNull() & (new_cond < new_sale)
    empty = F.lit(None).cast("string")
    lines = F.array(
        F.concat(F.lit("<b>"), F.initcap(site), F.lit("</b> — "), escape_html(F.coalesce(name, F.lit("")))),
        F.nullif(escape_html(F.coalesce(brand, F.lit(""))), F.lit("")),
        F.lit(""),
        F.concat(F.lit("Price: "), F.when(old_sale != new_sale, change(old_sale, new_sale)).otherwise(money(new_sale))),
        F.when(member, F.concat(F.lit("Member price: "), F.when(old_cond.isNotNull() & (old_cond != new_cond), change(old_cond, new_cond)).otherwise(F.concat(F.lit("<b>"), money(new_cond), F.lit("</b>"))))).otherwise(empty),
        F.when(member, F.concat(F.bround((new_sale - new_cond) / F.nullif(new_sale, F.lit(0.0)) * 100, 0).cast("int").cast("string"), F.lit("% below the price"))).otherwise(empty),
        F.lit(""),
        F.concat(F.lit("<b>"), F.format_string("%.1f", pct), F.lit("%</b> down")),
        escape_html(F.coalesce(url, F.lit(""))),
    )
    return F.array_join(lines, "\n")
