"""Links between ids as DataFrames: components, and pairs across the blocks of a bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakepipe.session import written_once


def _rows_and_hash(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every id of ``links`` (a, b); a component is named by its smallest id.

    Alternating large-star and small-star steps, which need a number of rounds that grows with the
    logarithm of the longest path. Each round is a written table, so a lost executor costs a round.
    """
    ends = links.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst"))
    edges = written_once(ends.where("src > dst").distinct(), "edges")
    before = _rows_and_hash(edges)
    while True:
        both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("root"))
        # Large star: the larger neighbours of a node, and the node itself, go to the smallest of all.
        large = (
            both.join(least, "src")
            .where("dst > src")
            .select(F.col("dst").alias("src"), F.col("root").alias("dst"))
            .union(least.select("src", F.col("root").alias("dst")))
            .where("src > dst")
            .distinct()
        )
        # Small star: the smaller neighbours of a node go to the smallest of them.
        small = large.groupBy("src").agg(F.min("dst").alias("root"))
        edges = written_once(
            large.join(small, "src")
            .select(F.col("dst").alias("src"), F.col("root").alias("dst"))
            .union(small.select("src", F.col("root").alias("dst")))
            .where("src > dst")
            .distinct(),
            "edges",
        )
        after = _rows_and_hash(edges)
        if after == before:
            break
        before = after
    named = edges.groupBy("src").agg(F.min("dst").alias("component"))
    roots = edges.select(F.col("dst").alias("src"), F.col("dst").alias("component")).distinct()
    return named.union(roots).select(F.col("src").alias("node"), "component")


def across_blocks(members: DataFrame, keep=None, complete=lambda mixed: mixed) -> DataFrame:
    """Pairs (a, b) of nodes that share a bucket but not a block, as often as they share one.

    ``members`` has bucket, node, block and what ``keep(x, y)`` reads to refuse a pair of rows. Each
    bucket's largest block is paired with the rest of the bucket, and the rest with itself; a bucket
    of a single block has no rest and gives nothing, whatever its size. ``keep`` is part of the join's
    condition, so refused pairs are never rows. ``complete`` adds columns that only ``keep`` reads to the
    members of buckets of several blocks.
    """
    blocks = members.groupBy("bucket", "block").agg(F.count(F.lit(1)).alias("n"))
    largest = blocks.groupBy("bucket").agg(
        F.max_by("block", F.struct("n", "block")).alias("largest"), F.count(F.lit(1)).alias("blocks")
    )
    # Written, so that the join has exchanges of its own, whose hot partitions Spark can split.
    largest = written_once(largest.where("blocks > 1").drop("blocks"), "largest")
    mixed = written_once(complete(members.join(largest, "bucket")), "mixed")
    rest = mixed.where("block <> largest")

    def paired(left, right, apart):
        x, y = left.alias("x"), right.alias("y")
        on = (F.col("x.bucket") == F.col("y.bucket")) & apart
        if keep is not None:
            on &= keep("x", "y")
        a, b = F.col("x.node"), F.col("y.node")
        return x.join(y, on).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))

    one_way = (F.col("x.block") != F.col("y.block")) & (F.col("x.node") < F.col("y.node"))
    return paired(mixed.where("block = largest"), rest, F.lit(True)).union(paired(rest, rest, one_way))
