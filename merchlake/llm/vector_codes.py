"""Product codes of vectors: each part of a vector becomes the index of the nearest entry of that part's codebook.

Codebooks are fitted by rounds of assignment and averaging over all vectors, in
integers, so that results do not depend on how rows are spread.  The nearest
entry is found in two steps.  A float32 matrix product screens all entries;
its rounding error is bounded rigorously, so each distance lies in a known
interval.  Entries whose interval overlaps the best one's are evaluated
again in int64, and ties go to the smaller index.

Only codebooks (entries times dimensions) and sums of that size leave a
task; the driver holds one codebook.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage
from .line_runs import join_counted

#: Rows that are screened at a time.
BLOCK = 2048
_U32, _U64 = 2.0**-24, 2.0**-53


def largest(dimension: int) -> int:
    """The magnitude up to which squared distances of integer vectors, summed over all parts, stay within 63 bits."""
    return int((2**63 / max(1, dimension)) ** 0.5 / 2) - 1


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the index of the nearest row of book, the smallest of equally near ones, and the squared distance; all in int64.

    A dot product of m terms in float32, in any order of summation, is off
    by at most g * |x| * |c| with g = (m + 2) u / (1 - (m + 2) u): m
    roundings of sums and products, and one of each factor.
    """
    distinct = np.sort(np.unique(book, axis=0, return_index=True)[1])  # a repeated entry never wins over its first
    c = book[distinct]
    m = x.shape[1]
    g = (m + 2) * _U32 / (1 - (m + 2) * _U32)
    c32, cc = c.astype(np.float32), np.einsum("ij,ij->i", c, c).astype(np.float64)
    c_norm = np.sqrt(cc)
    index, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for at in range(0, len(x), BLOCK):
        b = x[at : at + BLOCK]
        dot = (b.astype(np.float32) @ c32.T).astype(np.float64)
        x_norm = np.sqrt(np.einsum("ij,ij->i", b, b).astype(np.float64))
        # twice the error of the product, and that of the few float64 operations around it
        off = (2 * g * (1 + 16 * _U64)) * np.outer(x_norm, c_norm) + 16 * _U64 * (cc + 2 * np.abs(dot))
        score = cc - 2 * dot
        row, entry = np.nonzero(score - off <= (score + off).min(axis=1, keepdims=True))
        gap = b[row] - c[entry]
        exact = np.einsum("ij,ij->i", gap, gap)
        best = np.minimum.reduceat(exact, np.searchsorted(row, np.arange(len(b))))  # every row has a candidate
        won = np.flatnonzero(exact == best[row])
        won = won[np.r_[True, row[won][1:] != row[won][:-1]]]  # entries ascend within a row
        index[at : at + BLOCK], distance[at : at + BLOCK] = distinct[entry[won]], best
    return index, distance


def integers(vectors: DataFrame, column: str, scale: int, parts: int) -> DataFrame:
    """vec_id, label, dimension and v, floor(scale * component) as int32, for vectors without null or non-finite components.

    Lengths that parts does not divide are filled up with zeros.  Components too large for exact distances take no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            if not isinstance(lists, pa.ListArray):
                lists = lists.cast(pa.list_(lists.type.value_type))
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            size = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, np.diff(at))
            with np.errstate(invalid="ignore", over="ignore"):
                scaled = np.floor(flat * scale)
            for d in np.unique(size[size > 0]).tolist():
                rows = np.flatnonzero(size == d)
                v = scaled[at[rows][:, None] + np.arange(d)]
                good = (np.abs(v) <= min(largest(d), 2**31 - 1)).all(axis=1)  # false for NaN
                if good.any():
                    v = np.pad(v[good], ((0, 0), (0, -d % parts))).astype("<i4")
                    kept = b.select(["vec_id", "label"]).take(pa.array(rows[good]))
                    yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(np.full(len(v), d), pa.int32()), pa.array([x.tobytes() for x in v], pa.binary())], ["vec_id", "label", "dimension", "v"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col(column).alias("v")).mapInArrow(run, f"vec_id long, label {label}, dimension int, v binary")


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<i4").reshape(len(rows), -1).astype(np.int64)


def _sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """part, entry, n and the sums of the components of the vectors' parts that are nearest to each entry; unused entries have no row."""
    parts, size, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("v"))
                for p in range(parts):
                    own = x[:, p * width : (p + 1) * width]
                    index, _ = nearest(own, books[p])
                    n[p] += np.bincount(index, minlength=size)
                    np.add.at(total[p], index, own)
        p, e = np.nonzero(n)
        cols = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e])] + [pa.array(np.ascontiguousarray(total[p, e, i])) for i in range(width)]
        yield pa.RecordBatch.from_arrays(cols, ["part", "entry", "n", *(f"s{i}" for i in range(width))])

    sums = [f"s{i}" for i in range(width)]
    told = rows.select("v").mapInArrow(run, "part int, entry int, n long, " + ", ".join(f"{s} long" for s in sums))
    return told.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in ("n", *sums)))


def fit(rows: DataFrame, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, component) after the rounds, from the parts of the vectors with the smallest vec_ids."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()  # entries rows at most
    start = np.stack([np.frombuffer(r.v, "<i4").astype(np.int64) for r in first])
    books = np.ascontiguousarray(start.reshape(len(first), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        for r in _sums(rows, books).collect():  # parts * entries rows at most
            books[r.part, r.entry] = [s // r.n for s in r[3:]]
    return books


def codes(vectors: DataFrame, column: str = "embedding", scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row of vectors (vec_id, label, column) that takes part.

    code has the index in each part's codebook, two hex digits each, error the sum of
    the parts' squared distances, label_error its sum over rows of one label, nulls together;
    the digest is of all entries' components in decimal, by part, entry and place.

    Rows whose vector is null, empty, or holds null or non-finite components
    take no part, nor do those with components too large for exact
    distances (``largest``: about 2**27 of scaled value at 64 dimensions) or
    with another length than the vector of the smallest vec_id.  Zeros fill up a length that
    parts does not divide.  Rows that share a vec_id are rows each, in the order
    of their vectors; null vec_ids come last.  Fewer rows than entries
    give smaller codebooks, no rows no result.  Other columns are not read.
    """
    spark = vectors.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: entries must be 1 to 256")
    stage = Stage(spark, "codes")
    label = vectors.schema["label"].dataType.simpleString()
    rows = stage.write(integers(vectors, column, scale, parts), "integers")
    head = rows.orderBy(F.asc_nulls_last("vec_id"), "v").select("dimension").first()
    out = f"vec_id long, code string, error long, label {label}"
    if head is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    rows = rows.where(F.col("dimension") == head[0])
    books = fit(rows, parts, entries, rounds)
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, found = _matrix(b.column("v")), np.empty((b.num_rows, parts), np.uint8)
                error = np.zeros(b.num_rows, np.int64)
                for p in range(parts):
                    found[:, p], off = nearest(x[:, p * width : (p + 1) * width], books[p])
                    error += off
                text = found.tobytes().hex()
                code = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(code, pa.string()), pa.array(error), b.column("label")], ["vec_id", "code", "error", "label"])

    coded = rows.select("vec_id", "label", "v").mapInArrow(run, out)
    by = ["no_label", "label_text"]
    coded = stage.write(coded.withColumns({"no_label": F.col("label").isNull(), "label_text": F.coalesce(F.col("label").cast("string"), F.lit(""))}).drop("label"), "coded")
    sums = stage.write(coded.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("error").alias("label_error")), "label-errors")
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return join_counted(coded, sums, by).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
