"""Train/test splits decided by a hash of the user, so they do not depend on row order or partitioning."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from lakepipe.functions.columns import key_hash

SEED = 42
TEST_SHARE_PCT = 20
ROWS_PER_FILE = 250_000
_HASH_BITS = 60
_RANGE_BITS = 16  # the hash space is cut into 2**16 ranges


def hash_split(users: DataFrame, key: str = "user_id", test_pct: int = TEST_SHARE_PCT, seed: int = SEED) -> DataFrame:
    """Add ``is_train``. No exchange at all; the test share holds per label only in expectation."""
    return users.withColumn("is_train", key_hash(F.col(key), seed) % 100 >= test_pct)


def _test_sizes(per_class: DataFrame, test_pct: int) -> DataFrame:
    """Test rows per class: the rounded-up share of all rows, divided by largest remainder.

    ``per_class`` has one row for buyers and one for the others, so the windows are two rows long.
    """
    everything = Window.partitionBy(F.lit(0))
    wanted = F.floor((F.sum("rows").over(everything) * test_pct + 99) / 100)
    # quotient and remainder of rows * wanted / all, in whole numbers
    product = F.col("rows").cast("decimal(19,0)") * F.col("wanted").cast("decimal(19,0)")
    sized = (
        per_class.withColumn("all_rows", F.sum("rows").over(everything))
        .withColumn("wanted", wanted)
        .withColumn("rest", (product % F.col("all_rows")).cast("bigint"))
        .withColumn("base", ((product - F.col("rest")) / F.col("all_rows")).cast("bigint"))
    )
    left_over = F.col("wanted") - F.sum("base").over(everything)
    place = F.row_number().over(everything.orderBy(F.desc("rest"), F.asc("_buyer")))
    return sized.select("_buyer", (F.col("base") + (place <= left_over).cast("int")).alias("test_rows"))


def stratified_split(
    labelled: DataFrame, key: str = "user_id", test_pct: int = TEST_SHARE_PCT, seed: int = SEED
) -> DataFrame:
    """Add ``is_train`` so that buyers (label 1) and the others each have a test part of exact size.

    The test part of a class are its ``n`` smallest (hash, key) pairs. Sorting a class in one
    window would put half of all users into one task. Instead the hash space is cut into 65,536
    equal ranges and counted; the running count finds the range in which the n-th pair lies, and
    only that range's rows (about 1 in 65,536, the hash is uniform over the unique keys) are
    ranked. What is broadcast is one row per class, and a boolean has two.
    """
    hashed = labelled.withColumns({"_hash": key_hash(F.col(key), seed), "_buyer": F.col("label").eqNullSafe(1)})
    coarse = F.shiftright("_hash", _HASH_BITS - _RANGE_BITS)
    slim = hashed.select("_buyer", F.col(key).alias("_key"), "_hash", coarse.alias("_range"))

    counted = slim.groupBy("_buyer", "_range").agg(F.count(F.lit(1)).alias("rows"))
    sizes = _test_sizes(counted.groupBy("_buyer").agg(F.sum("rows").alias("rows")), test_pct)
    upto = Window.partitionBy("_buyer").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    boundary = (
        counted.withColumn("_upto", F.sum("rows").over(upto))
        .join(F.broadcast(sizes), "_buyer")
        .where((F.col("_upto") >= F.col("test_rows")) & (F.col("_upto") - F.col("rows") < F.col("test_rows")))
        .select("_buyer", "_range", (F.col("test_rows") - F.col("_upto") + F.col("rows")).alias("_nth"))
    )
    ranked = Window.partitionBy("_buyer").orderBy("_hash", "_key")
    cut = (
        slim.join(F.broadcast(boundary), ["_buyer", "_range"])
        .withColumn("_place", F.row_number().over(ranked))
        .where("_place = _nth")
        .select("_buyer", F.col("_hash").alias("_cut_hash"), F.col("_key").alias("_cut_key"))
    )
    in_test = (F.col("_hash") < F.col("_cut_hash")) | (
        (F.col("_hash") == F.col("_cut_hash")) & (F.col(key) <= F.col("_cut_key"))
    )
    return (
        hashed.join(F.broadcast(cut), "_buyer", "left")
        .withColumn("is_train", ~F.coalesce(in_test, F.lit(False)))
        .select(*labelled.columns, "is_train")
    )


def in_fixed_order(
    users: DataFrame, rows: int, key: str = "user_id", rows_per_partition: int = ROWS_PER_FILE
) -> DataFrame:
    """The same rows in partitions and an order that depend on the unique key only.

    Bagging draws per row and partition, and aggregates leave their rows in the order the blocks
    happened to arrive, so a seed alone would not give the same model twice.
    """
    return users.repartition(max(1, math.ceil(rows / rows_per_partition)), key).sortWithinPartitions(key)


def split_summary(split: DataFrame) -> DataFrame:
    """Size and buyers of both parts."""
    return split.groupBy("is_train").agg(F.count(F.lit(1)).alias("users"), F.sum("label").alias("buyers"))
