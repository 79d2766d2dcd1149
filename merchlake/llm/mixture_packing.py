"""Packing with a controlled mixture: every window of tokens holds each source in its target share.

Each source's documents form a queue of tokens.  Deficit round-robin serves
the queues: in each round a queue earns its share of a window; it is served a
run of tokens once what it has earned and not yet spent covers the run, and
carries the rest on.  The runs, in the order of service, are one stream,
which is cut into windows.

A queue's deficit after r rounds is r times its share minus what it was
served, so the round of a run follows from where the run ends in its queue:
no state has to be handed from window to window or from task to task.
Places in queues are sums over earlier tasks; places in the stream are sums over
range partitions of the sorted runs, after the partitions before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage
from .word_tokens import word_tokens


def measure(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """row, doc_id, queue, task, at, n, ids of every row: its ids with the end id, and where in its task's part of the queue it begins.

    queue is the source behind an s, or n for a null one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = word_tokens(tokenizer_path), TaskContext.get().partitionId()
        end, size = np.array([end_id], enc.kind).tobytes(), enc.kind.itemsize
        row, served = task << 33, {}
        for b in batches:
            step = max(1, min(b.num_rows, int(4_000_000 * b.num_rows / max(1, b.nbytes))))
            for first in range(0, b.num_rows, step):
                part = b.slice(first, step)
                ids = [enc.ids(t) + end for t in part.column("text").to_pylist()]
                at, n = [], [len(x) // size for x in ids]
                for q, k in zip(part.column("queue").to_pylist(), n, strict=True):
                    at.append(served.get(q, 0))
                    served[q] = at[-1] + k
                rows = np.arange(row, row + len(n))
                row += len(n)
                yield pa.RecordBatch.from_arrays([pa.array(rows), part.column("doc_id"), part.column("queue"), pa.array([task] * len(n), pa.int32()), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["row", "doc_id", "queue", "task", "at", "n", "ids"])

    queue = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), queue.alias("queue"), "text").mapInArrow(run, "row long, doc_id long, queue string, task int, at long, n long, ids binary")


def shares(per_task: DataFrame, targets: Mapping[str | None, float] | None) -> DataFrame:
    """queue, task, before, tokens, phase, share: where each task's part of a queue begins, the queue's tokens, and its share of a window.

    Without targets a queue's share is that of its tokens, so all queues end together.
    """
    own, all_of = Window.partitionBy("queue"), F.sum("tokens_in_task")
    placed = per_task.withColumns({"before": all_of.over(own.orderBy("task")) - F.col("tokens_in_task"), "tokens": all_of.over(own), "weight": F.lit(None).cast("double")})
    if targets:
        named = [("n" if k is None else f"s{k}", float(v)) for k, v in targets.items() if v > 0]
        aims = per_task.sparkSession.createDataFrame(named, "queue string, aim double")  # the caller's mapping
        placed = placed.join(F.broadcast(aims), "queue", "left").withColumn("weight", F.col("aim")).drop("aim")
    # of the named queues there is one weight each, whatever the number of tasks that hold it
    sums = placed.groupBy("queue").agg(F.max("weight").alias("w"), F.max("tokens").alias("t")).agg(F.sum("w").alias("w"), F.sum(F.when(F.col("w").isNull(), F.col("t"))).alias("t")).first()
    named, rest = F.lit(float(sums.w or 1)), F.lit(float(sums.t or 1))
    return placed.withColumns({"phase": F.when(F.col("weight").isNull(), 1).otherwise(0), "share": F.coalesce(F.col("weight") / named, F.col("tokens") / rest)}).select("queue", "task", "before", "tokens", "phase", "share")


def served(rows: DataFrame, capacity: int, least_run: int) -> DataFrame:
    """row, start, length, phase, round, queue, place of every run of a row: rows have at (in their queue), n, tokens, phase and share."""
    earned = F.col("share") * capacity
    run = F.least(F.lit(capacity), F.greatest(F.lit(least_run), F.floor(earned))).cast("long")
    cut = rows.withColumns({"earned": earned, "run": run}).withColumn("u", F.explode(F.expr("sequence(at div run, (at + n - 1) div run)")))
    lo, hi = F.greatest(F.col("at"), F.col("u") * F.col("run")), F.least(F.col("at") + F.col("n"), (F.col("u") + 1) * F.col("run"))
    end = F.least((F.col("u") + 1) * F.col("run"), F.col("tokens"))
    return cut.select("row", (lo - F.col("at")).alias("start"), (hi - lo).alias("length"), "phase", F.ceil(end / F.col("earned")).alias("round"), "queue", lo.alias("place"))


def tail(total: int, capacity: int) -> list[int]:
    """Where the sequences after the last whole window begin, in the stream: their lengths are powers of two."""
    at, left, out = total - total % capacity, total % capacity, []
    while left:
        out.append(at)
        size = 1 << (left.bit_length() - 1)
        at, left = at + size, left - size
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, targets: Mapping[str | None, float] | None = None, least_run: int = 64) -> DataFrame:
    """Pack all rows of docs (doc_id, text, source) into sequences of at most capacity tokens, mixed by source.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  All sequences but the last few are full; those
    few have powers of two as lengths, so nothing is padded.

    targets maps sources (None: null) to weights; a queue that ends leaves its
    share to the others, and sources that targets does not name, or gives no weight, come
    after all others, by their tokens.  Without targets every source has the share
    of its tokens.  A source that earns less than least_run tokens a window is
    served that many at a time, in some of the windows: so in each window a
    source is off its share by less than twice the larger of that and its own share.

    A null or empty text is the end id alone; a null source is a source;
    rows that share a doc_id are packed each for itself; an empty table
    gives no rows; other columns are not read.
    """
    stage = Stage(docs.sparkSession, "mixture")
    rows = stage.write(measure(docs, tokenizer_path, end_id), "ids")
    per_task = stage.write(rows.groupBy("queue", "task").agg(F.sum("n").alias("tokens_in_task")), "queues")
    total = per_task.agg(F.coalesce(F.sum("tokens_in_task"), F.lit(0))).first()[0]
    queues = stage.write(shares(per_task, targets), "shares")
    light = rows.select("row", "queue", "task", "at", "n").join(queues, ["queue", "task"]).withColumn("at", F.col("at") + F.col("before"))
    order = ["phase", "round", "queue", "place"]

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            ends = at + np.cumsum(b.column("length").to_numpy())
            if len(ends):
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("start"), b.column("length"), pa.array(np.full(len(ends), part), pa.int32()), pa.array(ends - b.column("length").to_numpy())], ["row", "start", "length", "part", "in_part"])
                at = int(ends[-1])

    runs = served(light, capacity, least_run).repartitionByRange(*order).sortWithinPartitions(*order)
    stream = stage.write(runs.select("row", "start", "length").mapInArrow(along, "row long, start long, length long, part int, in_part long"), "stream")
    lengths = stream.groupBy("part").agg(F.sum("length").alias("l"))  # one row for each partition
    before = lengths.select("part", (F.sum("l").over(Window.orderBy("part")) - F.col("l")).alias("before"))
    pieces = stream.join(F.broadcast(before), "part").groupBy("row").agg(F.collect_list(F.struct("start", "length", (F.col("before") + F.col("in_part")).alias("place"))).alias("runs"))  # those of one document
    return cut(rows.select("row", "doc_id", "n", "ids").join(pieces, "row"), tokenizer_path, capacity, tail(total, capacity))


def cut(rows: DataFrame, tokenizer_path: str, capacity: int, last: list[int]) -> DataFrame:
    """The pieces of rows (doc_id, n, ids, runs): runs are cut where a sequence ends; last has the begins of those after the whole windows."""
    full = last[0] if last else None
    begins = np.array(last, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = word_tokens(tokenizer_path).kind
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [], [])
            lists = b.column("runs")
            flat, ends = lists.flatten(), np.cumsum(np.diff(lists.offsets.to_numpy()))
            starts, lengths, places = (flat.field(k).to_numpy(zero_copy_only=False).tolist() for k in ("start", "length", "place"))
            i = 0
            for doc, n, ids, end in zip(b.column("doc_id").to_pylist(), b.column("n").to_pylist(), b.column("ids").to_pylist(), ends.tolist(), strict=True):
                view = memoryview(np.frombuffer(ids, kind).astype("<u4").tobytes())
                for start, length, place in zip(starts[i:end], lengths[i:end], places[i:end], strict=True):
                    while length:
                        if full is not None and place >= full:
                            k = int(np.searchsorted(begins, place, "right")) - 1
                            sequence, offset = full // capacity + k, place - last[k]
                            room = (last[k + 1] if k + 1 < len(last) else place + length) - place
                        else:
                            sequence, offset = divmod(place, capacity)
                            room = capacity - offset
                        take = min(length, room)
                        for col, v in zip(cols, (doc, start, take, zlib.crc32(view[4 * start : 4 * (start + take)]), n, sequence, offset), strict=True):
                            col.append(v)
                        start, place, length = start + take, place + take, length - take
                i = end
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
