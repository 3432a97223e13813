"""The corpus pipeline: stages that each apply one operator to what the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import decontaminate, language_id
from tidebook.llm.jaccard_join import one_per_group
from tidebook.llm.packing import pack
from tidebook.llm.queries import table, tokenizer_path
from tidebook.llm.substring_dedup import cut_repeats
from tidebook.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from ``docs``; others go."""
    return language_id.in_a_language(docs, language_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest id."""
    return one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages; n_chars follows; documents of which nothing is left go."""
    # Other columns are renamed for the time of the cut, as they may be called like its own.
    names = [c if c in ("doc_id", "text", "n_chars") else f"c{i}" for i, c in enumerate(docs.columns)]
    renamed = docs.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(docs.columns, names)])
    cut = cut_repeats(renamed).filter("n_removed = 0 OR n_removed < n_words")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    cut = cut.withColumn("n_chars", n_chars)
    return cut.select(*[F.col(new).alias(old) for old, new in zip(docs.columns, names)])


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ``benchmark`` occurs."""
    return decontaminate.clean_of(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, a row per piece of a document."""
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontaminate", benchmark_free),
    ("packing", packed),
]

# SQL has no tokenizer and no byte model; tests/llm/test_pipeline.py holds a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
