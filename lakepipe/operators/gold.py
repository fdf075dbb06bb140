"""The three aggregate tables over clean events.

Each is one grouped aggregate with a map-side half, so a day, product or user that holds a third
of all rows reaches the exchange as one partial row per task. Distinct counts are first grouped by
(key, value), which spreads a hot key over its values; a user's distinct days and products are bitmaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakepipe.functions import money
from lakepipe.functions.columns import CART_EVENTS, PURCHASE, VIEW, events_of

COMMON_DAYS = 1  # the range of 32,768 days from 1970-01-02 to 2059-09-18; days outside are told apart one by one


def daily_revenue(silver: DataFrame, approximate: bool = False) -> DataFrame:
    """Purchases per day. A NULL event time forms its own group. Not sorted: see ``by_day``."""
    buyers = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    price = F.col("price")
    return (
        silver.where(F.col("event_type") == PURCHASE)
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("total_purchases"),
            money.total(price).alias("total_revenue"),
            money.mean(price).alias("avg_order_value"),
            buyers.alias("unique_buyers"),
        )
    )


def by_day(daily: DataFrame) -> DataFrame:
    """A table keeps no row order, so the order by date is applied when it is read."""
    return daily.orderBy(F.col("event_date").asc_nulls_first())


def product_performance(silver: DataFrame, cart_events: Sequence[str] = CART_EVENTS) -> DataFrame:
    """Per product, brand and price band. ``total_views`` counts all events, ``view_events`` the views."""
    counted = silver.groupBy("product_id", "brand", "price_category").agg(
        F.count(F.lit(1)).alias("total_views"),
        events_of(VIEW).alias("view_events"),
        events_of(PURCHASE).alias("purchases"),
        events_of(*cart_events).alias("cart_adds"),
        money.mean(F.col("price")).alias("avg_price"),
    )
    rate = F.round(F.col("purchases") / F.col("total_views") * 100, 2)
    return counted.withColumn("conversion_rate", rate)


def user_features(
    silver: DataFrame,
    cart_events: Sequence[str] = CART_EVENTS,
    approximate: bool = False,
    by_user: bool = False,
) -> DataFrame:
    """One row per user; missing numbers (NULL and NaN) are 0.

    The rows are grouped once per (user, day, product), with all sums. Two exact distinct counts over these groups
    would make Spark copy each group once per count; instead products and days are bits. A user's products of one
    range of 32,768 ids are one bitmap, so a user with a third of all rows is spread over its days and products
    first and over its ranges of products second, where a group is one narrow row per day and product of the range.
    Days are one bitmap per user, merged over the ranges. Only there bitmaps cross an exchange, one for each user
    and range.

    ``by_user`` says that all rows of a user are in one partition already, as in a table bucketed by it: then no
    exchange is needed at all.
    """
    price = F.col("price")
    sums = [
        F.count(F.lit(1)).alias("total_events"),
        events_of(PURCHASE).alias("purchases"),
        events_of(VIEW).alias("views"),
        events_of(*cart_events).alias("cart_adds"),
        *money.parts(F.when(F.col("event_type") == PURCHASE, price).otherwise(0.0), "spent"),
        *money.parts(price, "price"),
    ]
    if approximate:
        per_user = silver.groupBy("user_id").agg(
            *sums,
            F.approx_count_distinct("product_id").alias("unique_products"),
            F.approx_count_distinct("event_date").alias("active_days"),
        )
    else:
        added = [F.sum(c).alias(c) for c in ("total_events", "purchases", "views", "cart_adds")]
        added += [*money.combined("spent"), *money.combined("price")]
        grouped = silver.groupBy("user_id", "event_date", "product_id").agg(*sums)
        grouped = grouped.withColumn("product_range", F.bitmap_bucket_number("product_id"))
        if not by_user:
            grouped = grouped.repartition("user_id", "product_range")
        day = F.unix_date("event_date")
        common = F.bitmap_bucket_number(day) == COMMON_DAYS
        ranges = grouped.groupBy("user_id", "product_range").agg(
            *added,
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("product_id"))).alias("products"),
            F.bitmap_construct_agg(F.when(common, F.bitmap_bit_position(day))).alias("days"),
            F.collect_set(F.when(~common, day)).alias("odd_days"),
        )
        per_user = ranges.groupBy("user_id").agg(
            *added,
            F.sum("products").alias("unique_products"),
            F.bitmap_count(F.bitmap_or_agg("days")).alias("common_days"),
            F.size(F.array_distinct(F.flatten(F.collect_list("odd_days")))).alias("odd_days"),
        )
        per_user = per_user.withColumn("active_days", F.col("common_days") + F.col("odd_days"))
    return per_user.select(
        "user_id",
        "total_events",
        "purchases",
        "views",
        "cart_adds",
        money.total_of("spent").alias("total_spent"),
        money.mean_of("price").alias("avg_price"),
        "unique_products",
        "active_days",
    ).fillna(0)
