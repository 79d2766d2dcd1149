"""Best-fit packing of documents into sequences, after dominance reduction.

Pieces of equal length are interchangeable, so the plan is made on the
histogram of lengths: ``capacity`` counts at most, however many documents
there are.  Spark measures the pieces, the driver plans over the histogram,
and a join of ranges hands every piece its place.

The reduction follows Martello and Toth: a set of pieces around one piece
that *dominates* every other feasible set with that piece (whatever else the
piece could go with can be exchanged for what the set holds) is fixed for
good without losing the optimum.  Three cases, for a piece of length s with
room r = capacity - s, longest first, until none applies:

* nothing else fits in r: the piece stands alone;
* a piece of length r exists: the pair fills the sequence;
* no two of the other pieces fit in r together: the longest that fits goes with it.

What is left goes by best fit, longest first.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_tokens import byte_tokens
from .common import Stage, map_batches

#: Slots, cut into blocks of ranks, up to which they are broadcast (about 80 bytes each).
MOST_SLOTS = 200_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones of capacity, the rest first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    out = [(0, first)] if first else []
    return out + [(at, capacity) for at in range(first, n, capacity)]


def measure(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of every row: one row each, with the CRC-32 of its ids."""
    end = np.array([end_id], "<u4").tobytes()

    def run(c: dict) -> pa.RecordBatch:
        enc = byte_tokens(tokenizer_path)
        cols: tuple[list, ...] = ([], [], [], [], [])
        for doc, text in zip(c["doc_id"].to_pylist(), c["text"].to_pylist(), strict=True):
            ids = enc.ids(text) + end
            view = memoryview(ids)
            for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                for col, v in zip(cols, (doc, k, start, length, zlib.crc32(view[4 * start : 4 * (start + length)])), strict=True):
                    col.append(v)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select("doc_id", "text"), run, PIECE)


Patterns = list[tuple[tuple[int, ...], int]]


def reduce(counts: dict[int, int], capacity: int) -> tuple[Patterns, dict[int, int]]:
    """The sets that dominate, as patterns (lengths in one sequence, how many such sequences), and the histogram of what is left."""
    left = {s: n for s, n in counts.items() if n}
    sizes = sorted(left)
    patterns: Patterns = []

    def take(s: int, n: int) -> None:
        left[s] -= n
        if not left[s]:
            del left[s]
            sizes.pop(bisect.bisect_left(sizes, s))

    changed = True
    while changed:
        changed = False
        for s in sizes[::-1]:
            while n := left.get(s, 0):
                room = capacity - s
                others = [x for x in sizes[: bisect.bisect_right(sizes, room)] if x != s or n > 1]
                two = 2 * others[0] if others and left[others[0]] - (others[0] == s) > 1 else sum(others[:2]) if len(others) > 1 else capacity + 1
                if others and others[-1] != room and two <= room:
                    break  # nothing dominates here
                if not others:
                    patterns.append(((s,), n))
                elif others[-1] == s:
                    n //= 2
                    patterns.append(((s, s), n))
                    n *= 2
                else:
                    n = min(n, left[others[-1]])
                    patterns.append(((s, others[-1]), n))
                    take(others[-1], n)
                take(s, n)
                changed = True
    return patterns, left


def best_fit(left: dict[int, int], capacity: int) -> Patterns:
    """Best fit over sequences grouped by room, longest first; each group holds (pattern, how many)."""
    rooms: list[int] = []
    held: dict[int, list[list]] = {}

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in held:
            held[room] = []
            bisect.insort(rooms, room)
        held[room].append([pattern, n])

    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            at = bisect.bisect_left(rooms, s)
            if at == len(rooms):
                each = capacity // s
                if full := n // each:
                    put(capacity - each * s, (s,) * each, full)
                if rest := n % each:
                    put(capacity - rest * s, (s,) * rest, 1)
                break
            room = rooms[at]
            pattern, have = held[room][-1]
            used = min(n, have)
            if used == have:
                held[room].pop()
                if not held[room]:
                    del held[room]
                    rooms.pop(at)
            else:
                held[room][-1][1] -= used
            put(room - s, (*pattern, s), used)
            n -= used
    return [(p, n) for group in held.values() for p, n in group]


def reduce_and_pack(counts: dict[int, int], capacity: int) -> tuple[Patterns, dict[str, int]]:
    """Patterns for a histogram of lengths.

    Also says how many pieces the reduction fixed, and a lower bound of sequences.
    """
    fixed, left = reduce(counts, capacity)
    patterns = fixed + best_fit(left, capacity)
    bound = -(-sum(s * n for s, n in counts.items()) // capacity)
    return patterns, {"fixed": sum(len(p) * n for p, n in fixed), "bound": bound, "sequences": sum(n for _, n in patterns)}


def slots(patterns: Patterns) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges of ranks within a length: (length, first rank, end rank, first sequence, per sequence, offset).

    Piece number q of its length, first <= q < end, goes to sequence
    first_sequence + q - first at that offset.
    """
    out, used, sequence = [], {}, 0
    for pattern, n in patterns:
        offset = 0
        for s in pattern:
            q = used.get(s, 0)
            out.append((s, q, q + n, sequence, n, offset))
            used[s] = q + n
            offset += s
        sequence += n
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pack all rows of docs (doc_id, text) into sequences of at most capacity tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset.  A null or empty text is the end id alone; rows that share a
    doc_id are packed each for itself; an empty table gives no rows; other
    columns are not read.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "packing")
    # A number of each piece that is unique and, within a length and a task, dense: ranks need no sort of a whole length.
    pieces = stage.write(measure(docs, tokenizer_path, capacity, end_id).withColumn("task", F.spark_partition_id()), "pieces")
    per_task = stage.write(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    plan, _ = reduce_and_pack(counts, capacity)
    ranges = slots(plan)
    where = spark.createDataFrame(ranges, "length long, lo long, hi long, first long, n long, offset long")
    before = per_task.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))).select("length", "task", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = (
        pieces.withColumn("in_task", F.row_number().over(Window.partitionBy("length", "task").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1)
        .join(before, ["length", "task"])
        .withColumn("q", F.col("before") + F.col("in_task"))
    )
    # each piece finds its slot by (length, block of ranks): a slot of many sequences lies in many blocks
    block = 512
    cut_slots = where.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))))
    rows = sum((hi - 1) // block - lo // block + 1 for _, lo, hi, *_ in ranges)
    cut_slots = F.broadcast(cut_slots) if rows <= MOST_SLOTS else cut_slots.hint("merge")
    return (
        ranked.withColumn("block", F.floor(F.col("q") / block))
        .join(cut_slots, ["length", "block"])
        .where((F.col("q") >= F.col("lo")) & (F.col("q") < F.col("hi")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("q") - F.col("lo")).alias("sequence_id"), "offset")
    )
