"""Language identification as inference of a multilingual mixture.

Every language is a distribution over letter trigrams, learned from labelled
documents.  A document is a mixture: each of its trigrams comes from one of
the languages, with proportions that expectation-maximisation estimates.
Nested language sets (the best one, two, ... by proportion, up to all) are fitted and the
set with the best penalised likelihood is kept: a further language must gain
more than ``penalty`` times half the logarithm of the number of trigrams.  Sets
grow until a bound shows that no larger one can pay its penalty.

Trigrams of lower-case letters, words edged by a blank, fall into 2**16 bins.
All documents of a batch are fitted together on flat arrays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, map_batches

BINS = 1 << 16
UNKNOWN = "und"
#: Trigrams of other languages' words turn up in any text; a weaker mixture than this is not one.
PENALTY = 2.0
SMOOTHING = 0.5

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Lower-case letter of every code point, 0 where it is no letter."""
    global _letters
    if _letters is None:
        out = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                out[i] = ord(low) if len(low) == 1 else i
        _letters = out
    return _letters


def trigrams(text: str | None) -> np.ndarray:
    """Bins of the trigrams around every letter of a text."""
    if not text:
        return np.zeros(0, np.uint16)
    x = np.zeros(len(text) + 2, np.uint32)
    x[1:-1] = letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    with np.errstate(over="ignore"):
        h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(16)).astype(np.uint16)[x[1:-1] > 0]


def learn(docs: DataFrame, label: str = "lang") -> DataFrame:
    """lang, counts (2**16 longs, little-endian) of the trigrams of the labelled rows: one row for each language."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            own: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own.setdefault(lang, []).append(trigrams(text))
            for lang, found in own.items():
                n = np.bincount(np.concatenate(found), minlength=BINS)
                total[lang] = total[lang] + n if lang in total else n
        for lang, n in total.items():  # partial counts of a task: a row for each part of the bins
            for part in range(16):
                piece = n[part * BINS // 16 : (part + 1) * BINS // 16]
                if piece.any():
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([part], pa.int32()), pa.array([piece.tobytes()], pa.binary())], ["lang", "part", "n"])

    partial = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select(F.col(label).cast("string").alias("lang"), "text").mapInArrow(run, "lang string, part int, n binary")

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        n = sum(np.frombuffer(x, np.int64) for x in pdf["n"])
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "part": [pdf["part"].iloc[0]], "n": [n.tobytes()]})

    # two steps: by task first, so that no group holds a row for every task
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("n"), F.lit(16)))
    some = salted.groupBy("lang", "part", "salt").applyInPandas(add, "lang string, part int, n binary")
    return some.groupBy("lang", "part").applyInPandas(add, "lang string, part int, n binary")


#: Languages up to which the table of likelihoods (a quarter of a megabyte each) is sent to the tasks.
MOST_LANGUAGES = 512


class Mixture:
    def __init__(self, names: list[str], counts: np.ndarray, penalty: float = PENALTY, steps: int = 12):
        self.names, self.penalty, self.steps = names, penalty, steps
        rate = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=1, keepdims=True)
        self.rate = np.ascontiguousarray(rate.T.astype(np.float32)) * np.float32(BINS)  # scaled; only ratios matter

    def fit(self, p: np.ndarray, n: np.ndarray, start: np.ndarray, owner: np.ndarray, pi: np.ndarray, steps: int) -> np.ndarray:
        """EM from the proportions pi (documents x languages); zeros stay zeros."""
        total = np.add.reduceat(n, start)[:, None]
        for _ in range(steps):
            r = p * pi[owner]
            r *= (n / np.maximum(r.sum(axis=1), 1e-30))[:, None]
            pi = np.add.reduceat(r, start, axis=0) / total
        return pi

    def bound(self, p: np.ndarray, n: np.ndarray, start: np.ndarray, owner: np.ndarray, pi: np.ndarray) -> np.ndarray:
        """Log-likelihoods that no mixture exceeds.

        By Jensen's inequality the best mixture gains at most N log(max over
        languages of the mean of n p / m), m being the likelihoods under pi.
        """
        m = np.maximum((p * pi[owner]).sum(axis=1), 1e-30)
        total = np.add.reduceat(n, start)
        gain = np.add.reduceat(p * (n / m)[:, None], start, axis=0).max(axis=1) / total
        like = np.add.reduceat(n * np.log(m), start).astype(np.float64)
        most = like + total * np.log(np.maximum(gain, 1.0))
        return most + 1e-4 * (np.abs(most) + 1)  # single precision

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, float]]]]:
        """Language, its proportion, and the whole set with proportions, for each text."""
        out: list = [(UNKNOWN, 0.0, [])] * len(texts)
        bins, counts, own = [], [], []
        for i, t in enumerate(texts):
            g = trigrams(t)
            if len(g) and self.names:
                g.sort()
                at = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
                bins.append(g[at])
                counts.append(np.diff(np.r_[at, len(g)]))
                own.append(i)
        if not own:
            return out
        sizes = np.array([len(b) for b in bins])
        start = np.r_[0, np.cumsum(sizes)[:-1]]
        owner = np.repeat(np.arange(len(own)), sizes)
        p, n = self.rate[np.concatenate(bins)], np.concatenate(counts).astype(np.float32)
        k = len(self.names)
        pi = self.fit(p, n, start, owner, np.full((len(own), k), 1 / k, np.float32), self.steps)
        rank = np.argsort(-pi, axis=1, kind="stable")
        cost = self.penalty * 0.5 * np.log(np.add.reduceat(n, start))
        best, chosen = np.full(len(own), -np.inf), np.zeros_like(pi)
        most = self.bound(p, n, start, owner, pi)
        live = np.arange(len(own))  # documents that a further language may still pay for
        for size in range(1, k + 1):
            open_ = most[live] - cost[live] * (size - 1) > best[live]
            if not open_.any():
                break
            if not open_.all():
                held = open_[owner]
                live, p, n = live[open_], p[held], n[held]
                sizes = sizes[open_]
                start = np.r_[0, np.cumsum(sizes)[:-1]]
                owner = np.repeat(np.arange(len(live)), sizes)
            rows = np.arange(len(live))
            part = np.zeros((len(live), k), pi.dtype)
            for j in range(size):
                at = rank[live, j]
                part[rows, at] = np.maximum(pi[live, at], 1e-6)
            part /= part.sum(axis=1, keepdims=True)
            if size > 1:
                part = self.fit(p, n, start, owner, part, 3)
            like = np.add.reduceat(n * np.log(np.maximum((p * part[owner]).sum(axis=1), 1e-30)), start) - cost[live] * (size - 1)
            better = like > best[live]
            best[live[better]], chosen[live[better]] = like[better], part[better]
        for i, x in zip(own, chosen, strict=True):
            shares = sorted(((float(v), j) for j, v in enumerate(x) if v > 0), key=lambda v: (-v[0], v[1]))
            out[i] = (self.names[shares[0][1]], min(1.0, shares[0][0]), [(self.names[j], v) for v, j in shares])
        return out


def identify(docs: DataFrame, training: DataFrame, label: str = "lang", penalty: float = PENALTY) -> DataFrame:
    """doc_id, lang_pred, score (its proportion) and mixture (lang, share) of every row of docs.

    training (text, label) may be any table; rows with a null label or text teach
    nothing.  A text that is null or has no letter, or any text if nothing was
    learned, is ``und`` with score 0.  Repeated rows are told alike; other columns are not read.
    """
    stage = Stage(docs.sparkSession, "languages")
    table = stage.write(learn(training, label), "counts")
    names = sorted(r[0] for r in table.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((len(names), BINS), np.int64)
    for lang, part, n in table.toLocalIterator():
        counts[names.index(lang), part * BINS // 16 : (part + 1) * BINS // 16] = np.frombuffer(n, np.int64)
    sent = docs.sparkSession.sparkContext.broadcast((names, counts.astype(np.float64)))
    made: list[Mixture] = []

    def run(c: dict) -> pa.RecordBatch:
        if not made:
            made.append(Mixture(*sent.value, penalty))
        found = made[0].predict(c["text"].to_pylist())
        mixture = [[{"lang": a, "share": b} for a, b in x[2]] for x in found]
        return pa.RecordBatch.from_arrays([c["doc_id"].cast(pa.int64()), pa.array([x[0] for x in found]), pa.array([x[1] for x in found], pa.float64()), pa.array(mixture, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))], ["doc_id", "lang_pred", "score", "mixture"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double, mixture array<struct<lang:string,share:double>>")
