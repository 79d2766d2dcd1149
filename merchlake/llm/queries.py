"""One query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .oracles import ORACLE


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_duplicates import classes

    return classes(documents(spark, sf_dir))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import dedup

    return dedup(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judge

    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import nearest

    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.pmod("vec_id", F.lit(100)) == 0, 10)


def op5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .languages import identify

    docs = documents(spark, sf_dir)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    told = identify(docs.select("doc_id", "text"), docs.where(F.coalesce(~held_out, F.lit(True))).select("text", "lang"))
    return told.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("mixture").alias("n_languages"))


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_runs import dedup

    out = dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", "longest_run", "longest_gap", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), 1024, 2)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op9_graded_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .graded_quality import grade_documents

    # graded ratings: 0 is toxic, 1 junk, 2 sound and clean
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return grade_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", grade.alias("grade")))


def op10_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .piece_tokens import digests

    return digests(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resampling import resample

    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import codes

    return codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixture_packing import pack

    return pack(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), 2048, 1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_near_duplicates, op2_substrings, op3_quality_rules, op4_neighbours, op5_languages, op6_line_runs, op7_packing, op8_token_counts, op9_graded_quality, op10_piece_tokens, op11_resampling, op12_vector_codes, op13_mixture_packing)}

__all__ = ["ORACLE", "QUERIES"]
