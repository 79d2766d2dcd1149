"""Line deduplication by a suffix array over line ids.

A document is its sequence of line ids.  Prefix doubling sorts the suffixes:
ranks of blocks of 2**k lines give, in pairs (p, p + 2**k), the ranks of
blocks of twice the length, by a range-partitioned sort of the distinct pairs.  A
block that occurs once ends its suffix's part, so only repeated blocks go on
and each round is smaller than the last.

A rank at depth 2**k is an interval of the suffix array whose longest common
prefix is 2**k lines at least; its first member in document order is the copy
that stays.  For every later copy the ranks, from the deepest level on which
it has an earlier copy down, give the exact length of the common prefix with that copy: the
maximal repeated run.  The lines of later copies are deleted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT, LAST_ID, Stage, join_counted, map_batches
from .substrings import small_side

__all__ = ["HOT", "dedup", "join_counted", "levels", "line_ids", "repeated_runs"]

AT = ["doc", "key", "pos"]


def line_ids(docs: DataFrame) -> DataFrame:
    """doc, key, pos, l1, l2: a 128-bit id of every line that has a word; other lines belong to no run."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64("text").alias("key"), "text")

    def run(c: dict) -> pa.RecordBatch:
        doc, key, pos, digest = [], [], [], []
        for d, k, text in zip(c["doc"].to_pylist(), c["key"].to_pylist(), c["text"].to_pylist(), strict=True):
            for i, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n") if text else ()):
                if line.strip(b" \t\n\v\f\r"):
                    doc.append(d)
                    key.append(k)
                    pos.append(i)
                    digest.append(xxhash.xxh3_128_digest(line))
        ids = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(key, pa.int64()), pa.array(pos, pa.int32()), pa.array(np.ascontiguousarray(ids[:, 0])), pa.array(np.ascontiguousarray(ids[:, 1]))], [*AT, "l1", "l2"])

    return map_batches(own, run, "doc long, key long, pos int, l1 long, l2 long")


def _ranked(blocks: DataFrame, by: list[str], stage: Stage) -> DataFrame:
    """The blocks (doc, key, pos and the columns by) that occur twice or more: rank, in the order of by, and first, the first position."""
    same = blocks.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*AT)).alias("first")).where("n > 1")
    # ascending over range partitions: the number of a row is its rank
    ranks = stage.write(same.repartitionByRange(*by).sortWithinPartitions(*by).select(*by, "n", F.monotonically_increasing_id().alias("rank"), "first"), "ranks")
    return stage.write(join_counted(blocks, ranks, by).select(*AT, "rank", "first"), "blocks")


def levels(docs: DataFrame, stage: Stage) -> list[DataFrame]:
    """For k = 0, 1, ...: the positions where a repeated block of 2**k lines starts, with its rank and first position."""
    lines = stage.write(line_ids(docs), "lines")
    twice = stage.write(lines.groupBy("l1", "l2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "twice")
    out = [_ranked(stage.write(join_counted(lines, twice, ["l1", "l2"]).distinct(), "repeated"), ["l1", "l2"], stage)]
    stage.drop(lines)
    while not out[-1].isEmpty():
        a, step = out[-1], 1 << (len(out) - 1)
        head = a.select(*AT, F.col("rank").alias("r1"))
        tail = a.select("doc", "key", (F.col("pos") - step).alias("pos"), F.col("rank").alias("r2"))
        out.append(_ranked(stage.write(head.join(tail, AT), "pairs"), ["r1", "r2"], stage))
    return out[:-1]


def repeated_runs(docs: DataFrame, stage: Stage | None = None) -> DataFrame:
    """doc, key, pos, length, first: every maximal run of lines whose copy begins at the earlier position first.

    key tells rows apart that share a doc_id.  A run starts where the line
    before is not in a run with the same copy.
    """
    stage = stage or Stage(docs.sparkSession, "runs")
    found = levels(docs, stage)
    later = None
    for k, level in enumerate(found):
        copies = level.where(F.col("first") < F.struct(*AT)).select(*AT, F.lit(k).alias("k"), "first")
        later = copies if later is None else later.unionByName(copies)
    if later is None:
        return docs.sparkSession.createDataFrame([], "doc long, key long, pos int, length int, first struct<doc:long,key:long,pos:int>")
    deepest = stage.write(later.groupBy(*AT).agg(F.max(F.struct("k", "first")).alias("m")).select(*AT, "m.k", "m.first"), "later")
    before = deepest.select("doc", "key", (F.col("pos") + 1).alias("pos"), F.col("first").alias("b"))
    goes_on = (F.col("b.doc") == F.col("first.doc")) & (F.col("b.key") == F.col("first.key")) & (F.col("b.pos") + 1 == F.col("first.pos"))
    starts = stage.write(deepest.join(before, AT, "left").where(~F.coalesce(goes_on, F.lit(False))).select(*AT, "k", "first", F.expr("shiftleft(1, k)").alias("length")), "starts")
    done = starts.where("k = 0")  # a copy of two lines would have an earlier copy at level 1
    going = starts.where("k > 0")
    for k in range(len(found) - 2, -1, -1):
        level = found[k]
        mine = level.select("doc", "key", (F.col("pos")).alias("end"), F.col("rank").alias("own"))
        theirs = level.select(F.col("doc").alias("fd"), F.col("key").alias("fk"), F.col("pos").alias("fe"), F.col("rank").alias("its"))
        open_ = going.where(F.col("k") > k).withColumns({"end": F.col("pos") + F.col("length"), "fd": F.col("first.doc"), "fk": F.col("first.key"), "fe": F.col("first.pos") + F.col("length")})
        grown = open_.join(mine, ["doc", "key", "end"], "left").join(theirs, ["fd", "fk", "fe"], "left")
        longer = F.when(F.col("own") == F.col("its"), F.col("length") + (1 << k)).otherwise(F.col("length"))
        going = stage.write(grown.select(*AT, "k", "first", longer.cast("int").alias("length")).unionByName(going.where(F.col("k") <= k)), "grown")
    return done.unionByName(going).select(*AT, "length", "first")


def dedup(docs: DataFrame, min_lines: int = 2) -> DataFrame:
    """Every row of docs with n_lines, n_removed, n_runs, longest_run, longest_gap and kept, the text without its later copies.

    Lines are what ``\\n`` separates; lines without a word stay.  A run of
    min_lines or more repeated lines is deleted wherever an earlier copy of
    it exists, in document order (doc_id, nulls last, then position); copies
    are judged on the input.  n_runs and longest_run are of the maximal runs, which may
    overlap; longest_gap is the longest stretch of lines deleted in a row.  kept is null if nothing was left of the text or
    if it was null, a null text has no lines, an empty one has one.  Rows
    alike in doc_id and text are one document.  An empty table gives no
    rows.  Other columns are passed on, but for the names doc, key, runs,
    n_lines, n_removed, n_runs, longest_run, longest_gap and kept.
    """
    stage = Stage(docs.sparkSession, "lines")
    runs = repeated_runs(docs.select("doc_id", "text"), stage).where(F.col("length") >= min_lines)
    lists = stage.write(runs.groupBy("doc", "key").agg(F.collect_list(F.struct("pos", "length")).alias("runs")), "runs")
    taken = ("doc", "key", "runs", "n_lines", "n_removed", "n_runs", "longest_run", "longest_gap", "kept")
    own = docs.drop(*taken).withColumns({"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "key": F.xxhash64("text")})
    joined = own.join(small_side(lists), ["doc", "key"], "left").drop("doc", "key")
    names = [c for c in joined.columns if c not in ("runs", "text")]

    def run(c: dict) -> pa.RecordBatch:
        rows = []
        for text, runs in zip(c["text"].to_pylist(), c["runs"].to_pylist(), strict=True):
            lines = [] if text is None else text.split("\n")
            gone = {p for r in runs or () for p in range(r["pos"], r["pos"] + r["length"])}
            kept = text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)
            gap = longest = 0
            for i in sorted(gone):
                gap = gap + 1 if i - 1 in gone else 1
                longest = max(longest, gap)
            rows.append((len(lines), len(gone), len(runs or ()), max((r["length"] for r in runs or ()), default=0), longest, None if gone and not kept.strip(" \t\n\v\f\r") else kept))
        cols = list(zip(*rows, strict=True))
        kinds = (pa.int64(),) * 5 + (pa.string(),)
        return pa.RecordBatch.from_arrays([*(c[n] for n in names), c["text"], *(pa.array(x, k) for x, k in zip(cols, kinds, strict=True))], [*names, "text", *taken[3:]])

    schema = joined.select(*(f"`{n}`" for n in names), "text").withColumns({n: F.lit(0).cast("long") for n in taken[3:8]} | {"kept": F.lit("")}).schema
    return map_batches(joined.select(*(f"`{n}`" for n in names), "text", "runs"), run, schema)
