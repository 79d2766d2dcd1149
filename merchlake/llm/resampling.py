"""Importance resampling towards a target distribution, in built-in functions only.

Texts become hashed counts of word n-grams.  A bucket's gain is the
logarithm of how much likelier it is in the target than in the documents; a
document's weight is the sum of its features' gains.  Gumbel noise, which follows
from the doc_id, is added, and the highest scores are a draw without
replacement in proportion to the weights' exponentials.

All steps are DataFrame operations: n-gram arrays are exploded, their CRC-32
modulo the number of buckets is counted with partial aggregation, the table
of gains (one row for each bucket) is broadcast to the exploded features and summed by
row, and the ranks are places in range partitions after the rows of the
partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage

#: A fixed value: what separates words, all of ASCII but digits and lower-case letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The part of monotonically_increasing_id() that counts within a partition.
_IN_PART = (1 << 33) - 1


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; pure ASCII takes the short way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """The words of a text in lower case; null for null."""
    return F.array_remove(F.split(lower_ascii(text), _BETWEEN, -1), "")


def buckets_of(found: Column, longest: int, buckets: int) -> Column:
    """The bucket of each run of 1 to longest consecutive words, repeats included."""

    def hashed(gram: Column) -> Column:
        return (F.crc32(gram) % buckets).cast("int")

    def runs(n: int) -> Column:
        if n == 1:
            return F.transform(found, hashed)
        return F.transform(F.slice(found, F.lit(1), F.greatest(F.size(found) - (n - 1), F.lit(0))), lambda _, i: hashed(F.array_join(F.slice(found, i + 1, F.lit(n)), " ")))

    return F.concat(*(runs(n) for n in range(1, longest + 1))) if longest > 1 else runs(1)


def counts(features: DataFrame, name: str) -> DataFrame:
    return features.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def gains(stage: Stage, source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """bucket, gain of every bucket: floor(1000 ln) of the ratio of the two smoothed shares. One row for each bucket."""
    s, t = stage.write(counts(source, "s"), "source-counts"), stage.write(counts(target, "t"), "target-counts")
    total_s, total_t = (x.agg(F.coalesce(F.sum(c), F.lit(0)).cast("double")).first()[0] for x, c in ((s, "s"), (t, "t")))
    both = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left")
    own = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double") + 1.0
    ratio = own("t") * F.lit(total_s + buckets) / (own("s") * F.lit(total_t + buckets))
    return stage.write(both.select("bucket", F.floor(F.ln(ratio) * 1000.0).cast("long").alias("gain")), "gains")


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 times a Gumbel value) that follows from seed and doc_id; a null doc_id counts as an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.ln(-F.ln((h + 0.5) / 4294967296.0)) * -1000.0).cast("long")


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, seed: int = 2024, percent: int = 10, least_words: int = 20) -> DataFrame:
    """Every row of docs (doc_id, text) with n_features, weight, score and its rank among those drawn, else null.

    target has a column text.  Of the N rows with least_words words or more,
    floor(percent * N / 100) are drawn: the highest scores, ties by the
    smaller doc_id, nulls last.  Null and empty texts have no features and
    weight 0.  Rows that share a doc_id are documents each, with the same noise; rows equal in all
    that is returned take neighbouring ranks.  An empty table gives no rows; an
    empty target gives a uniform one.  Other columns are not read.  buckets bounds what is broadcast (a row
    of two numbers each).
    """
    stage = Stage(docs.sparkSession, "resampling")
    split = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"))
    own = stage.write(split.select("row", "doc_id", F.coalesce(F.size("words"), F.lit(0)).alias("n_words"), buckets_of(F.col("words"), longest, buckets).alias("buckets")), "features")
    aims = stage.write(target.select(words(F.col("text")).alias("words")).select(buckets_of(F.col("words"), longest, buckets).alias("buckets")), "target")
    table = gains(stage, own, aims, buckets)

    each = own.select("row", "doc_id", "n_words", F.explode_outer("buckets").alias("bucket")).join(F.broadcast(table), "bucket", "left")
    summed = each.groupBy("row", "doc_id", "n_words").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"))
    scored = stage.write(summed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    stage.drop(own, aims)

    drawable = F.col("n_words") >= least_words
    drawn = scored.where(drawable).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features"), F.col("row")]
    placed = stage.write(scored.where(drawable).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "places")
    part = F.shiftright("place", 33).alias("part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))  # one row for each partition
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit(_IN_PART)) + 1
    ranked = placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn("rank", F.when(rank <= drawn, rank))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*out).unionByName(scored.where(~drawable).withColumn("rank", F.lit(None).cast("long")).select(*out))
