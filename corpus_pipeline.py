"""A corpus pipeline: quality rules, line dedup, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents; n_chars follows the text.
A row with a null doc_id, or with the doc_id of another, is a document like any
other; of rows equal in doc_id and text the quality and the near-dedup stage leave
one, the other stages treat rows as they come.
Null and empty texts have no words: the quality stage's base rejects them.  Columns
beyond those of documents are left out, so none can clash.  An empty table gives
an empty one at every stage.

A stage's result is written before the next stage is called; that one then
removes what the stage before it staged.  Which tables these are, a mark in the
result's columns tells, which Parquet keeps: runs that are interleaved, and
results that are held and not yet written, do not touch each other's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import line_runs, near_duplicates, packing, quality_rules, substrings
from merchlake.llm.common import Stage, let_go, watched
from merchlake.llm.queries import tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: The mark of a stage's result in the metadata of its doc_id, and what the stage staged, by mark.
MARK = "merchlake.stage"
_staged: dict[str, list[Stage]] = {}


def _clear(docs: DataFrame) -> None:
    """Remove what the stage that docs come from staged, unless docs still read it."""
    mark = docs.schema["doc_id"].metadata.get(MARK)
    if mark in _staged:
        read = docs.inputFiles()
        if not any(s.root.rsplit("/", 1)[1] in f for s in _staged[mark] for f in read):
            for s in _staged.pop(mark):
                s.clear()
            let_go(docs.sparkSession)


def _step(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _clear(docs)
        with watched() as made:
            out = step(spark, docs, sf_dir)
        mark = uuid.uuid4().hex
        _staged[mark] = list(made)
        return out.withMetadata("doc_id", {MARK: mark})

    return run_step


def _with_text(docs: DataFrame, kept: str, changed: str) -> DataFrame:
    """The documents with their new text; changed ones that nothing is left of go, unchanged ones stay as they are."""
    return docs.where(F.col(kept).isNotNull() | ~F.expr(changed)).withColumns({"n_chars": F.when(F.col(kept).eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length(kept).cast("long")), "text": F.col(kept)}).select(*COLUMNS)


def _rows(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """The documents with row, a number of each row, and key, a digest of the text; written, so that the numbers stay."""
    return Stage(spark, name).write(docs.select(*COLUMNS).withColumns({"row": F.monotonically_increasing_id(), "key": F.sha2("text", 256)}), "rows")


def _one_each(rows: DataFrame) -> DataFrame:
    """row: of rows equal in doc_id and text, null or not, the first by lang, source, n_chars."""
    return rows.groupBy("doc_id", "key").agg(F.min(F.struct("lang", "source", "n_chars", "row")).alias("one")).select("one.row")


@_step
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base or a rule with a controlled risk rejects go.

    Each row is judged for itself, also where its doc_id is null or another
    row's too; of the kept rows that are equal in doc_id and text one stays.
    """
    rows = _rows(spark, docs, "quality")
    judged = quality_rules.judge(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=("row",))
    kept = _one_each(rows.drop("text").join(judged.where("kept").select("row"), "row", "left_semi"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


@_step
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of two lines or more are deleted; a document that consists of them goes.

    Rows that share a doc_id stand in the order of a digest of their texts; rows
    alike in both are one document and treated alike.  Null texts go on as they are.
    """
    return _with_text(line_runs.dedup(docs.select(*COLUMNS)).withColumn("kept", F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept"))), "kept", "n_removed > 0")


@_step
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays, one with a null doc_id only if no other has one.

    Each row is a document of its own, also where its doc_id is null or another
    row's too; of one doc_id the row with the smallest digest of its text stays.
    Texts without words are in no group, but of rows equal in doc_id and text one stays.
    """
    rows = _rows(spark, docs, "near-rows")
    classes = near_duplicates.classes(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "class_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "lang", "source", "n_chars", "row")
    least = rows.drop("text").join(classes, "row").groupBy("class_id").agg(F.min(order).alias("one")).select("one.*")
    return rows.join(_one_each(least), "row", "left_semi").select(*COLUMNS)


@_step
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document holds are removed; the texts they are removed from keep their words, joined by blanks.

    Rows with a null doc_id come last; they, and rows that share a doc_id, do not remove from one
    another.  A document that nothing is left of goes; one without words goes on as it is.
    """
    out = substrings.dedup(docs.select(*COLUMNS))
    kept = F.when(F.col("n_removed") == 0, F.col("text")).when(F.col("n_removed") < F.col("n_words"), F.col("kept"))
    return _with_text(out.withColumn("kept", kept), "kept", "n_removed > 0")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in sequences of 1024 tokens; a null or empty text is its end id alone."""
    _clear(docs)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), 1024, 2)


STAGES = [("quality rules", quality), ("line dedup", lines), ("MinHash near-dedup", near), ("substring dedup", passages), ("best-fit packing", packed)]

#: No SQL: sketches, connected classes and the packing are out of its reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, step) in enumerate(STAGES):
        before, docs = docs, step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage.write(docs, name.replace(" ", "-"))
            if i:
                stage.drop(before)
    return docs
