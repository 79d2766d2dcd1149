"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= j | text) = logistic(t_j - w.x), with one weight vector for all
grades and ordered thresholds t_1 < t_2 < ...; x marks which hashed features a
text has: its words without their marks, the first four and five letters of
them, and the shapes of marks and capitals around them, in 2**18 bins.  The expected
grade and the probability of a grade or better follow from the same model, and
the latter selects.

Bins whose share of a grade's documents differs from that grade's share by
chance take no part: a bin needs ``least`` documents and a deviation of
``screen`` standard errors.  The weights are fitted on a documented, bounded
sample of the rated documents (``sample`` at most, the first by a hash of doc_id), which is
chosen on ids and grades alone.
Each step of L-BFGS is one pass of Spark over the sample's features: the tasks
add up the gradient side by side, and the sums have the size of the model, whatever the
sample's.  All documents are then scored in one pass.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, Stage, map_batches
from .substrings import small_side

BITS = 18
SAMPLE = 40_000
#: Grades are 0 to one less than this.
MOST_GRADES = 32

#: Marks that do not belong to a word.
_MARKS = ".,;:!?\"'()[]{}*#%&$|<>-_"


def features(word: str) -> tuple[int, ...]:
    """The bins of a word: what it is, how it begins, what shape it has."""
    core = word.strip(_MARKS)
    at = word.find(core) if core else len(word)
    case = "U" if len(core) > 1 and core.isupper() else "T" if core[:1].isupper() else "l"
    low = core.lower()
    own = {f"s{word[:at]}{case}{word[at + len(core) :]}", *(f"p{low[:k]}" for k in (4, 5) if len(low) > k)}
    if low:
        own.add(f"w{low}")
    return tuple(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) >> (64 - BITS) for x in own)


def text_bins(text: str | None, known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Bins of a text's words, each once."""
    return np.unique(np.fromiter(chain.from_iterable(map(known.__getitem__, set(text.split()))), np.int32)) if text else np.zeros(0, np.int32)


_known = Recent(features, 100_000)


def hashed(docs: DataFrame, *names: str) -> DataFrame:
    """The named long columns, and bins, of every row."""

    def run(c: dict) -> pa.RecordBatch:
        bins = [text_bins(t, _known) for t in c["text"].to_pylist()]
        return pa.RecordBatch.from_arrays([*(c[n].cast(pa.int64()) for n in names), pa.array(bins, pa.list_(pa.int32()))], [*names, "bins"])

    return map_batches(docs.select(*names, "text"), run, "".join(f"{n} long, " for n in names) + "bins array<int>")


def grade_counts(rated: DataFrame, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents by grade, and by grade and bin. All tasks send their sums at once; the sample bounds their number and size."""

    def run(batches):
        n, by = np.zeros(grades, np.int64), np.zeros((grades, 1 << BITS), np.int32)
        for b in batches:
            bins, row = _flat(b.column(1))
            grade = b.column(0).to_numpy().astype(np.int64)
            n += np.bincount(grade, minlength=grades)
            np.add.at(by, (grade[row], bins), 1)
        if n.any():
            at = np.flatnonzero(by)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (n, at.astype("<i4"), by.ravel()[at])], ["n", "at", "bins"])

    n, by = np.zeros(grades, np.int64), np.zeros(grades << BITS, np.int64)
    for a, at, b in rated.select("grade", "bins").mapInArrow(run, "n binary, at binary, bins binary").collect():
        n += np.frombuffer(a, np.int64)
        by[np.frombuffer(at, "<i4")] += np.frombuffer(b, np.int32)
    by = by.reshape(grades, -1)
    return n, by


def telling(n: np.ndarray, by: np.ndarray, screen: float, least: int) -> np.ndarray:
    """Which bins take part."""
    total, share = by.sum(axis=0), n[:, None] / n.sum()
    spread = np.sqrt(np.maximum(total * share * (1 - share), 1e-9))
    return (total >= least) & ((np.abs(by - total * share) / spread).max(axis=0) >= screen)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


class Ordinal:
    """Parameters: weights, the first threshold, logarithms of the gaps to the next ones."""

    def __init__(self, params: np.ndarray, grades: int):
        self.params, self.grades = params, grades

    @property
    def weights(self) -> np.ndarray:
        return self.params[: 1 << BITS]

    @property
    def thresholds(self) -> np.ndarray:
        tail = self.params[1 << BITS :]
        return tail[0] + np.r_[0.0, np.cumsum(np.exp(tail[1:]))]

    def score(self, bins: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """The linear predictor of each row."""
        return np.bincount(row, self.weights[bins], rows) if len(bins) else np.zeros(rows)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ... by row."""
        return _sigmoid(score[:, None] - self.thresholds)

    def loss(self, bins: np.ndarray, row: np.ndarray, grade: np.ndarray) -> tuple[float, np.ndarray]:
        """Negative log-likelihood of the rows and its gradient."""
        rows, t = len(grade), self.thresholds
        s = self.score(bins, row, rows)
        edge = np.r_[-np.inf, t, np.inf]
        upper, lower = _sigmoid(edge[grade + 1] - s), _sigmoid(edge[grade] - s)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        grad = np.zeros_like(self.params)
        ds = du - dl  # of the loss by the linear predictor
        grad[: 1 << BITS] = np.bincount(bins, ds[row], 1 << BITS) if len(bins) else 0
        dt = np.bincount(grade, -du, self.grades)[: self.grades - 1] + np.bincount(grade, dl, self.grades)[1:]
        grad[1 << BITS] = dt.sum()
        gaps = np.exp(self.params[(1 << BITS) + 1 :])
        grad[(1 << BITS) + 1 :] = [dt[j + 1 :].sum() * g for j, g in enumerate(gaps)]
        return float(-np.log(p).sum()), grad


def fit(rated: DataFrame, n: np.ndarray, by: np.ndarray, l2: float = 1.0, steps: int = 40) -> Ordinal:
    """The penalised maximum-likelihood model of rated (grade, bins), by L-BFGS with a pass over rated for each step.

    n, by: documents by grade, and by grade and bin.
    """
    spark, grades = rated.sparkSession, len(n)
    share = np.clip(np.cumsum(n / n.sum())[:-1], 1e-6, 1 - 1e-6)
    start = np.log(share / (1 - share))
    params = np.r_[np.zeros(1 << BITS), start[0], np.log(np.maximum(np.diff(start), 1e-3))]
    # curvature by coordinate, roughly: the first metric of the search
    metric = np.r_[1 / (l2 + 0.1 * by.sum(axis=0)), np.full(grades - 1, 10.0 / n.sum())]

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        sent = spark.sparkContext.broadcast(x)

        def run(batches):
            loss, grad = 0.0, None
            model = Ordinal(sent.value, grades)
            for b in batches:
                bins, row = _flat(b.column(1))
                part, g = model.loss(bins, row, b.column(0).to_numpy().astype(np.int64))
                loss += part
                grad = g if grad is None else grad + g
            if grad is not None:
                at = np.flatnonzero(grad)
                yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([at.astype("<i4").tobytes()], pa.binary()), pa.array([grad[at].tobytes()], pa.binary())], ["loss", "at", "value"])

        loss, grad = 0.5 * l2 * float(x[: 1 << BITS] @ x[: 1 << BITS]), np.zeros_like(x)
        grad[: 1 << BITS] = l2 * x[: 1 << BITS]
        for part, at, v in rated.select("grade", "bins").mapInArrow(run, "loss double, at binary, value binary").collect():
            loss += part
            grad[np.frombuffer(at, "<i4")] += np.frombuffer(v)
        sent.destroy()
        return loss, grad

    f, g = value(params)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, alphas = g.copy(), []
        for s, y, rho in reversed(past):
            alphas.append(rho * (s @ q))
            q -= alphas[-1] * y
        q *= metric * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ (metric * past[-1][1])) if past else 1.0)
        for (s, y, rho), a in zip(past, reversed(alphas), strict=True):
            q += (a - rho * (y @ q)) * s
        slope, size = float(g @ q), 1.0
        while True:
            new = params - size * q
            nf, ng = value(new)
            if nf <= f - 1e-4 * size * slope or size < 1e-4:
                break
            size *= 0.3
        s, y = new - params, ng - g
        done = f - nf <= 1e-5 * max(1.0, abs(f))
        params, f, g = new, nf, ng
        if s @ y > 1e-12:
            past = [*past[-9:], (s, y, 1.0 / float(s @ y))]
        if done:
            break
    return Ordinal(params, grades)


def grade_documents(docs: DataFrame, ratings: DataFrame, grade: str = "grade", sample: int = SAMPLE, l2: float = 1.0, screen: float = 10.0, least: int = 8, at_least: int | None = None, level: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_probability (of at_least, the best grade by default) and kept (it is level or more) for every row of docs.

    ratings (doc_id, grade: 0, 1, ...) may cover some of docs; grades that are null,
    negative or MOST_GRADES and more, those of absent or null documents, and those of a
    doc_id that several rows share (which one was rated is open) teach nothing.  Without ratings, or with one grade only, every document has
    that grade (0).  A null or empty text is scored without
    any word.  Repeated rows are scored alike; other columns are not read.
    """
    stage = Stage(docs.sparkSession, "grades")
    given = ratings.where((F.col(grade) >= 0) & (F.col(grade) < MOST_GRADES) & F.col("doc_id").isNotNull()).select("doc_id", F.col(grade).cast("long").alias("grade"))
    once = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    rated = stage.write(given.join(once.select("doc_id"), "doc_id"), "ratings")
    # the part of the hashes that holds at most `sample` rows, found by a histogram; no text takes part
    n, place, parts = rated.count(), F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 50)) / float(1 << 50), 4096
    if n > sample:
        width = min(1.0, 1.1 * sample / n) / parts
        counts = dict(rated.where(place < width * parts).groupBy(F.floor(place / width).alias("part")).count().collect())  # 4096 rows at most
        kept = int(np.searchsorted(np.cumsum([counts.get(i, 0) for i in range(parts)]), sample, "right"))
        rated = stage.write(rated.where(F.floor(place / width) < kept), "sample")
    bins = stage.write(hashed(docs.select("doc_id", "text").join(small_side(rated), "doc_id"), "grade"), "rated")
    grades = (bins.agg(F.max("grade")).first()[0] or 0) + 1
    if grades < 2:
        return docs.select("doc_id", F.lit(0.0).alias("expected_grade"), F.lit(1.0).alias("tail_probability"), F.lit(True).alias("kept"))
    n, by = grade_counts(bins, grades)
    mask = telling(n, by, screen, least)
    sent_mask = docs.sparkSession.sparkContext.broadcast(mask)

    def thin(c: dict) -> pa.RecordBatch:
        own = [x[sent_mask.value[x]] for x in (v.values.to_numpy(zero_copy_only=False) for v in c["bins"])]
        return pa.RecordBatch.from_arrays([c["grade"], pa.array(own, pa.list_(pa.int32()))], ["grade", "bins"])

    small = stage.write(map_batches(bins, thin, "grade long, bins array<int>"), "screened")
    model = fit(small, n, by * mask, l2)
    sent = docs.sparkSession.sparkContext.broadcast(model.params)
    known: list[Recent] = []

    best = grades - 1 if at_least is None else at_least

    def run(c: dict) -> pa.RecordBatch:
        own = Ordinal(sent.value, grades)
        if not known:  # words with the bins that take part, mostly none
            known.append(Recent(lambda w: tuple(b for b in features(w) if sent_mask.value[b]), 200_000))
        found = [text_bins(t, known[0]) for t in c["text"].to_pylist()]
        row = np.repeat(np.arange(len(found)), [len(x) for x in found])
        tails = own.tails(own.score(np.concatenate(found), row, len(found)))
        p = tails[:, best - 1] if best else np.ones(len(found))
        return pa.RecordBatch.from_arrays([c["doc_id"].cast(pa.int64()), pa.array(tails.sum(axis=1)), pa.array(p), pa.array(p >= level)], ["doc_id", "expected_grade", "tail_probability", "kept"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, expected_grade double, tail_probability double, kept boolean")
