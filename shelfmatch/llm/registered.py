"""The registered queries of the training-data operators, with production parameters, and their SQL where there is some."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import toxicity
from .collocations import collocations
from .common import documents, work_folder
from .decontaminate import contamination
from .line_dedup import line_dedup
from .lm_score import lm_score
from .minhash import near_duplicates
from .packing import pack
from .periodic_runs import digest as runs_digest
from .periodic_runs import periodic_runs, repeat_tail
from .quality import quality_rules
from .secrets import digest, find_secrets
from .simhash import hex_print, simhash
from .suffix_dedup import digest as suffix_digest
from .suffix_dedup import remove_repeated
from .token_files import crc_of, read_token_files, write_token_files

SPARK: dict = {}
SQL: dict = {}


def query(fn):
    SPARK[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_digest(remove_repeated(documents(spark, sf_dir)))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup(documents(spark, sf_dir))
    return lines.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(documents(spark, sf_dir)).select("doc_id", hex_print("print").alias("fingerprint"), "component_id")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(documents(spark, sf_dir)))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    scored = toxicity.score(docs, toxicity.fit(docs, labels, ~held_out))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words", "kept_sha256")


@query
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return lm_score(documents(spark, sf_dir), good)


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "token-files")
    write_token_files(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return crc_of(read_token_files(spark, folder))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_digest(periodic_runs(documents(spark, sf_dir), repeat_tail))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


@query
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
