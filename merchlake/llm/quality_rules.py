"""Quality rules with cutoffs that bound the share of good documents they reject.

Each rule rejects documents whose signal is above a cutoff.  On the labelled
documents, a stratum's good ones show how often a cutoff rejects falsely:
with k of n rejected, the exact binomial test of "the true rate is at least
r" has the p-value P(Bin(n, r) <= k).  A cutoff is admitted where this is at
most delta / (strata * rules * cutoffs) (Bonferroni over all that is tried),
which is the same as a Clopper-Pearson upper bound below r at that level.
Of the admitted cutoffs a rule takes the one that rejects the most documents
labelled bad beyond the good ones it rejects, the laxest among equals; none, if
that is no gain.  Rules share the risk alpha equally, r = alpha / rules, so that in every stratum, with confidence
1 - delta, the rules together reject at most alpha of the good documents.

Where a stratum has too few good documents to prove anything, its rules
reject nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage, map_batches, word_list

#: The bytes counted as symbols.
_SYMBOLS = b"#*$%&|<>"

#: Signals lie in 0..1; the cutoffs tried for each, from strict to lax.
CUTOFFS = tuple(round(0.02 * i, 2) for i in range(1, 50))
RULES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "long_word_share")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words in windows of that many words that occur twice or more, first occurrences included."""
    n = len(words)
    if n <= width:
        return 0
    number = dict(zip(words, range(n), strict=True))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    key = ids[: n - width + 1]
    for j in range(1, width):
        if n > 2_000_000:
            key = np.unique(key, return_inverse=True)[1]
        key = key * n + ids[j : n - width + 1 + j]
        if j < width - 1:
            key = np.unique(key, return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(key) + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for j in range(width):
        covered[j : j + len(key)] |= twice[: len(key)]
    return int(covered.sum())


def features(docs: DataFrame, stratum: str = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, stratum ("" for null), counts of every row's whole text and its columns carry; a null text counts as empty."""

    def run(c: dict) -> pa.RecordBatch:
        rows = []
        for text in c["text"].to_pylist():
            words = word_list(text)
            raw = text.encode("utf-8", "surrogatepass") if text else b""
            seen: set[bytes] = set()
            dup = lines = 0
            for line in raw.split(b"\n"):
                if line.strip(b" \t\n\v\f\r"):
                    lines += 1
                    if line in seen:
                        dup += 1
                    seen.add(line)
            joined = b"".join(words)
            letters = _ascii_letters(joined)
            rows.append((len(words), len(joined) - _continuation(joined), sum(map(raw.count, _EACH)), dup, repeated_words(words), lines, *letters))
        cols = list(zip(*rows, strict=True)) if rows else [()] * len(COUNTS)
        return pa.RecordBatch.from_arrays([c["doc_id"].cast(pa.int64()), c["stratum"].cast(pa.string()), *(pa.array(x, pa.int64()) for x in cols), *(c[x] for x in carry)], ["doc_id", "stratum", *COUNTS, *carry])

    own = docs.select("doc_id", "text", *carry, F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))
    return map_batches(own, run, "doc_id long, stratum string, " + ", ".join([f"{x} long" for x in COUNTS] + [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema]))


_EACH = [bytes([b]) for b in _SYMBOLS]
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_CONTINUATION = bytes(range(0x80, 0xC0))


def _continuation(raw: bytes) -> int:
    """Bytes that are no first byte of a character."""
    return len(raw) - len(raw.translate(None, _CONTINUATION))


def _ascii_letters(raw: bytes) -> tuple[int, int]:
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return upper, upper + len(raw) - len(raw.translate(None, _LOWER))


def signals() -> dict[str, Column]:
    """The rules' signals; an empty denominator gives 0."""
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "n_letters"),
        "long_word_share": F.least(F.lit(1.0), share("word_chars", "n_words") / 40),
    }


def base_failed(min_words: int = 50, repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def binomial_tail(k: int, n: int, r: float) -> float:
    """P(Bin(n, r) <= k)."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(r) + (n - i) * math.log1p(-r) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def thresholds(calibration: DataFrame, alpha: float = 0.03, delta: float = 0.05) -> DataFrame:
    """stratum, rule, cutoff of each rule in each stratum; rules without an admitted cutoff are absent.

    calibration has one row per labelled document: stratum, the rules'
    signals, good (boolean).  Only counts per stratum, rule and cutoff are
    gathered.
    """
    rate = alpha / len(RULES)
    # how many cutoffs reject a document: a histogram instead of a row per document and cutoff
    above = F.aggregate(F.array(*map(F.lit, CUTOFFS)), F.lit(0), lambda acc, c: acc + F.when(F.col("x") > c, 1).otherwise(0))
    counts = (
        calibration.select("stratum", "good", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("x")) for r in RULES))).alias("s"))
        .select("stratum", "good", "s.*")
        .groupBy("stratum", "rule", above.alias("above"))
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    tests = max(1, calibration.select("stratum").distinct().count()) * len(RULES) * len(CUTOFFS)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        n, best = int(pdf["good"].sum()), (0, 0.0)
        for i, cutoff in enumerate(CUTOFFS):
            over = pdf[pdf["above"] > i]
            k, caught = int(over["good"].sum()), int(over["bad"].sum())
            if k <= n * rate and binomial_tail(k, n, rate) <= delta / tests:
                best = max(best, (caught - k, cutoff))
        rows = [(pdf["stratum"].iloc[0], pdf["rule"].iloc[0], best[1])] if best[0] > 0 else []
        return pd.DataFrame(rows, columns=["stratum", "rule", "cutoff"])

    return counts.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff double")


#: Strata up to which the table of cutoffs, at most one short row each, is broadcast.
FEW_STRATA = 20_000


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.03, delta: float = 0.05, stratum: str = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """The counts of every row of docs, base_failed, and kept: neither the base nor a rule of its stratum rejects it.

    labels (doc_id, quality: 1 is good, 0 bad) is the holdout, one trial for each
    document: labels of one doc_id that agree count once, those that do not,
    null ones, and those of absent documents or of documents that fail the base take no part, nor
    do those of a doc_id whose rows differ, since which one was labelled is open.  A
    null stratum is a stratum of its own.  Repeated rows are judged alike,
    each in its own row; other columns are not read, but those of carry are passed on; an empty table gives no
    rows.
    """
    stage = Stage(docs.sparkSession, "quality")
    rows = stage.write(features(docs, stratum, carry).withColumn("base_failed", base_failed()), "counts")
    found = signals()
    told = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min(F.col("quality") > 0).alias("good"), F.max(F.col("quality") > 0).alias("most")).where("good = most")
    one = F.struct("stratum", "base_failed", *(found[r].alias(r) for r in RULES))
    seen = rows.join(told.select("doc_id", "good"), "doc_id").groupBy("doc_id").agg(F.min("good").alias("good"), F.min(one).alias("one"), F.max(one).alias("other"))
    labelled = seen.where("one = other AND NOT one.base_failed").select("one.stratum", "good", *(F.col(f"one.{r}") for r in RULES))
    cutoffs = stage.write(thresholds(labelled, alpha, delta).groupBy("stratum").pivot("rule", [*RULES]).agg(F.first("cutoff")), "cutoffs")
    few = cutoffs.count() <= FEW_STRATA
    rejected = F.lit(False)
    for r in RULES:
        rejected |= F.coalesce(found[r] > F.col(f"cutoff_{r}"), F.lit(False))
    return (
        rows.join(F.broadcast(cutoffs.toDF("stratum", *(f"cutoff_{r}" for r in RULES))) if few else cutoffs.toDF("stratum", *(f"cutoff_{r}" for r in RULES)), "stratum", "left")
        .withColumn("kept", ~F.col("base_failed") & ~rejected)
        .select("doc_id", *COUNTS[:5], "base_failed", "kept", *carry)
    )
