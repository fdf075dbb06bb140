"""Distinct buyers of any range of days from one mergeable sketch per day.

An exact distinct count over a range reads all purchases of the range. A HyperLogLog sketch of a day's
buyers has a few kilobytes whatever the day's size, is written once and merged with others of any range: of
days, of late batches of the same day, of weeks. A buyer in several of them counts once. Sketches of one table
must have the same precision ``lg_k``; 2 ** lg_k registers give a standard error of 1.04 / sqrt(2 ** lg_k).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from lakepipe.functions.columns import PURCHASE

LG_K = 14  # 0.8 % standard error, up to 16 KB a day


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The share of the exact count by which an estimate is off at most, but for one case in 370 (of three deviations)."""
    return deviations * 1.04 / math.sqrt(2**lg_k)


def daily_buyers(silver: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(event_date, purchases, buyers): each day's number of purchases and the sketch of its buyers.

    Each task sends one sketch per day, so a day that holds a third of all rows is a few kilobytes per task. A day
    may have several rows, of batches sketched apart. Events without a user count as purchases and are no buyers.
    """
    bought = silver.where(F.col("event_type") == PURCHASE)
    return bought.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("purchases"), F.hll_sketch_agg("user_id", lg_k).alias("buyers")
    )


def merged(sketches: DataFrame, *keys: Column) -> DataFrame:
    """One row per ``keys``: purchases added, sketches united, and the estimated number of different buyers."""
    united = sketches.groupBy(*keys).agg(F.sum("purchases").alias("purchases"), F.hll_union_agg("buyers").alias("buyers"))
    return united.withColumn("estimate", F.hll_sketch_estimate("buyers"))


def by_week(sketches: DataFrame) -> DataFrame:
    """``merged`` per calendar week, named by its Monday; days without a date are a group of their own."""
    return merged(sketches, F.date_trunc("week", "event_date").cast("date").alias("week"))


def trailing(sketches: DataFrame, days: int) -> DataFrame:
    """``merged`` for every day with purchases over it and the ``days - 1`` days before it.

    Each sketch is copied to the days it counts for: ``days`` rows of a few kilobytes per day of the table, never rows
    of events.
    """
    counted = sketches.where("event_date IS NOT NULL")
    reach = F.sequence(F.col("event_date"), F.date_add("event_date", days - 1))
    copies = counted.select("purchases", "buyers", F.explode(reach).alias("until"))
    present = counted.select(F.col("event_date").alias("until")).distinct()
    return merged(copies.join(present, "until", "left_semi"), F.col("until"))


def off_by_more(estimate: Column, exact: Column, lg_k: int = LG_K, deviations: float = 3.0) -> Column:
    """Whether an estimate is further from the exact count than the bound allows; half a buyer is rounding."""
    return F.abs(estimate - exact) > exact * relative_error(lg_k, deviations) + 0.5
