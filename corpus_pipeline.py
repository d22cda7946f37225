"""Cleaning pipeline over ``documents``: language ID, near-duplicates, repeated spans, benchmark leaks, mixing.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before it kept and is written as Parquet in the
shared folder and read again, so a lost executor costs one stage at most.  All stages but the last return the
columns of ``documents``; the last adds ``mix_copy`` and ``mix_words``, one row per copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import decontaminate, lang_id, mixing, simhash, span_dedup
from chatloom.session import work_dir
from chatloom.sources.fs import remove_tree


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_id.keep_identified(docs, lang_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, words=3, max_bits=2)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return span_dedup.clean_corpus(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.materialise(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("repeated_spans", repeated_spans),
          ("benchmark_leaks", benchmark_leaks), ("mix_sources", mix_sources)]

# language models, fingerprints and edit distances have no SQL form: tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = work_dir(spark, "pipeline"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:  # what the next stage no longer reads
            remove_tree(spark, before)
        before = f"{folder}/{name}"
    return docs
