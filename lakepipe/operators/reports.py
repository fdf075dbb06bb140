"""Reports over the published tables. Ties are broken so that a report is the same every time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakepipe.functions import money
from lakepipe.functions.columns import percentage


def event_type_distribution(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_type").count().orderBy(F.desc("count"), F.asc_nulls_last("event_type"))


def top_revenue_days(daily: DataFrame, n: int = 10) -> DataFrame:
    return (
        daily.select("event_date", "total_revenue", "total_purchases", "unique_buyers")
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("event_date"))
        .limit(n)
    )


def purchase_funnel(products: DataFrame) -> DataFrame:
    """Three percentages over all products; NULL where the divisor is 0."""
    views, carts, purchases = (F.sum(c) for c in ("total_views", "cart_adds", "purchases"))
    return products.agg(
        percentage(carts, views).alias("view_to_cart_pct"),
        percentage(purchases, carts).alias("cart_to_purchase_pct"),
        percentage(purchases, views).alias("overall_conversion_pct"),
    )


def prediction_summary(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("purchase_label")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.round(money.mean(F.col("total_spent")), 2).alias("avg_spend"),
            F.round(money.mean(F.col("purchase_probability")), 4).alias("avg_score"),
        )
        .orderBy(F.desc_nulls_last("avg_spend"), F.asc_nulls_last("purchase_label"))
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One unsorted (layer, rows) row per table."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return row_counts(tables).orderBy("layer")


def cleaning_delta(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """How many rows cleaning took out."""
    counts = row_counts({"bronze": bronze, "silver": silver})
    of = {layer: F.sum(F.when(F.col("layer") == layer, F.col("rows"))) for layer in ("bronze", "silver")}
    return counts.agg(
        of["bronze"].alias("bronze_rows"),
        of["silver"].alias("silver_rows"),
        (of["bronze"] - of["silver"]).alias("rows_removed"),
    )
