"""Label and feature columns of the purchase models."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

# The model's input columns. ``total_spent`` is above 0 exactly for buyers; all events less
# views and carts are the purchases, and users rarely see a product twice, so their products less views
# and carts nearly are. The second list has none of the three.
FEATURE_SETS = {
    "reference": (
        "total_events",
        "views",
        "cart_adds",
        "total_spent",
        "avg_price",
        "unique_products",
        "active_days",
    ),
    "no_leak": ("views", "cart_adds", "avg_price", "active_days"),
}
DEFAULT_FEATURES = "no_leak"


def with_label(users: DataFrame) -> DataFrame:
    """1 for users with a purchase."""
    return users.fillna(0).withColumn("label", (F.col("purchases") > 0).cast("int"))


def feature_matrix(users: DataFrame, feature_set: str = DEFAULT_FEATURES) -> DataFrame:
    return with_label(users).select("user_id", *FEATURE_SETS[feature_set], "label")


def assembler(feature_set: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURE_SETS[feature_set]), outputCol="features")


def label_distribution(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("label").count().orderBy(F.desc("count"), F.asc("label"))


def buyer_rate(labelled: DataFrame) -> DataFrame:
    return labelled.agg((F.avg("label") * 100).alias("buyer_rate_pct"))
