"""Batch scoring of all users with a stored model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from lakepipe.functions.columns import verdict
from lakepipe.ml.training import apply


def as_predictions(scored: DataFrame) -> DataFrame:
    """The predictions table from a frame with ``prediction``, ``score`` and ``is_train``."""
    return scored.select(
        "user_id",
        "total_events",
        "total_spent",
        "avg_price",
        F.col("prediction").alias("will_purchase"),
        F.bround("score", 4).alias("purchase_probability"),
        verdict(F.col("prediction")).alias("purchase_label"),
        "is_train",
    )


def score_users(model: PipelineModel, split: DataFrame) -> DataFrame:
    """Everyone is scored, also those the model was trained on; ``is_train`` tells them apart."""
    return as_predictions(apply(model, split))
