"""Corpus pipeline: each stage works on what the stage before it kept, read back from Parquet.

`run` applies STAGES to `documents`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm import decontamination, language_id, ngram_join, packing, substring_dedup
from tracemill.llm.common import shared_folder

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without letters or with an unsure guess go."""
    model = language_id.train(docs)
    found = language_id.identify(docs, model)
    return found.where("lang_pred <> 'und' and score >= 0.5").select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    groups = ngram_join.similar_documents(docs, count_links=False)
    others = groups.where("doc_id <> group_id").select("doc_id")
    return docs.join(others, "doc_id", "left_anti").select(*DOCUMENT_COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut; documents without any other word go."""
    cut = substring_dedup.remove_repeats(docs, layout=True)
    cut = cut.where("n_removed = 0 or n_removed < n_words").withColumn("n_chars", F.length("text").cast("long"))
    return cut.select(*DOCUMENT_COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a question of the benchmark, also re-parameterised, go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = decontamination.contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(*DOCUMENT_COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Which tokens of which document stand where in which training sequence."""
    return packing.pack_documents(docs, ids=False, added=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", languages),
    ("ngram_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("packing", sequences),
]

#: A trained model decides in the first stage, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
