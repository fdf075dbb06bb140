"""The corpus pipeline: five stages over ``documents``, each of which writes a table the next one reads.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. The first four return the columns of
``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakepipe.llm import decision_list, line_templates, ngram_join, packing, quality_model
from lakepipe.session import importable_by_workers, written_once

#: Near duplicates: five-word shingles, similarity of 80 percent or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
SEQUENCE_LENGTH = 1024
TOKENIZER = "byte_bpe_50k.json"


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score of the factorisation machine reaches 0.3."""
    importable_by_workers(spark)
    return quality_model.keep_good(docs, _labels(spark, sf_dir), F.lit(True), threshold=0.3)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned rule rejects."""
    return decision_list.keep_good(docs, _labels(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates; the first document of a template keeps them."""
    importable_by_workers(spark)
    cleaned = line_templates.cleaned(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates the document with the smallest id."""
    importable_by_workers(spark)
    return ngram_join.one_per_component(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that hold all remaining documents."""
    import public_tokenizers

    importable_by_workers(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), SEQUENCE_LENGTH).drop("ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("packing", pack),
]

#: SQL can express neither a trained classifier nor tokens; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
