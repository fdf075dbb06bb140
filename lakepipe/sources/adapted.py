"""The raw feed's shape, derived from the generic ``events`` table.

That table has no NULLs, no duplicates and no conflicting event types, so cleaning it would do
nothing. The derivation keeps every row, blanks some values and repeats some rows as purchases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _blank_every(step: int, value: Column) -> Column:
    return F.when(F.col("event_id") % step != 0, value)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")
    product = F.get_json_object("props", "$.k").cast("bigint")
    day = F.dayofmonth("ts")
    kind = _blank_every(
        97,
        F.when((F.col("event_type") == "click") & (F.col("event_id") % 4 == 0), "add_to_cart")
        .when(F.col("event_type") == "click", "cart")
        .when(F.col("event_type") == "purchase", "purchase")
        .otherwise("view"),
    )
    repeats = F.when(F.col("event_id") % 50 == 0, F.array(kind, F.lit("purchase"))).otherwise(F.array(kind))
    # Prices below a cent, in steps that every engine adds exactly.
    sixteenths = F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 16) / 16.0).otherwise(0.0)
    return events.withColumn("product_id", product).select(
        F.date_trunc("second", "ts").alias("event_time"),
        F.explode(repeats).alias("event_type"),
        "product_id",
        F.when(
            F.col("product_id") % 7 != 0,
            F.concat(F.lit("Brand#"), (F.col("product_id") % 25).cast("string")),
        ).alias("brand"),
        _blank_every(83, F.col("value") * 10 - 50 + sixteenths).alias("price"),
        _blank_every(89, F.col("user_id") * 31 + day).alias("user_id"),
        _blank_every(101, F.concat(F.col("user_id").cast("string"), F.lit("-"), day.cast("string"))).alias("user_session"),
    )
