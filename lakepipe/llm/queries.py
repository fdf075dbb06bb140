"""The dealt operators as named queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakepipe.llm import (
    bpe,
    decision_list,
    html_text,
    language_model,
    licenses,
    line_templates,
    ngram_join,
    oracles,
    packing,
    quality_model,
    ranked_search,
    token_counts,
    vector_join,
    whitening,
)
from lakepipe.session import importable_by_workers, written_once

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable_by_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), width=3, percent=90)


def _remainder(divisor: int) -> Column:
    """crc32 of the id's decimal digits, modulo ``divisor``; null where the id is null."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query
def op2_kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(_table(spark, sf_dir, "documents"), _remainder(7) == 2)


@query
def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_templates.drop_recurring(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "dropped_lines", "text")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op5_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), length=1024, closing_id=0)
    return packed.drop("ids")


@query
def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    statistics = written_once(decision_list.text_statistics(docs).drop("given"), "statistics")
    rules = decision_list.learn_from(statistics, _table(spark, sf_dir, "labels"))
    return statistics.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        decision_list.base_failed().alias("base_failed"),
        (~decision_list.base_failed() & rules.keeps()).alias("kept"),
    )


@query
def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op8_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


@query
def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, remainder = _table(spark, sf_dir, "documents"), _remainder(5)
    model = quality_model.train(docs, _table(spark, sf_dir, "labels"), remainder != 0)
    return quality_model.score(docs, model).select(
        "doc_id",
        F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


@query
def op11_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=4)


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), limit=1024)


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
