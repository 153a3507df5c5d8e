"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadwatch.llm import decontaminate, exact_dedup, lang_id, ngram_join, packing
from roadwatch.llm.queries import tokenizer_file
from roadwatch.session import remove_folder, run_dir, scratch


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language is not recognised, go."""
    return lang_id.keep_known(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar texts one document stays."""
    return ngram_join.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in pieces, with their place in the training sequences; ``packing.sequences``
    puts the pieces of a sequence together."""
    return packing.pack_tokens(docs, tokenizer_file())


STAGES = [
    ("language id", known_languages),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", packed_sequences),
]

#: SQL states neither a trained classifier nor the similarity search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written and read again.

    A stage's own tables, and its input if a stage wrote it, are deleted once its result is written. Null texts
    are rejected by the first stage; repeated rows and ties leave one row, as the stages say; an empty table
    gives an empty result.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES, 1):
        path = run_dir(spark, f"pipeline-{number}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
