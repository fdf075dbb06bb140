"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, then verification.

A hash rotates the vector by three rounds of random signs and a fast Hadamard transform and takes the
nearest of the 2 * d signed axes. ``hashes`` of them name a bucket of a table; a vector enters its own
bucket and those in which any hash takes the second nearest axis instead (multiprobe), in ``tables``
tables. At a cosine of 0.93 in 64 dimensions one table misses a pair with a probability of about 0.31,
so ten miss one in 100,000; closer pairs are missed far more rarely.

Dense groups do not cost their square. Vectors within half the angle of the threshold of one centre
are all linked with each other, whatever the pair; a first pass finds centres (the first vector of
each bucket) and counts such a block's links from its size. Only pairs across blocks are verified one
by one. Two vectors may share up to 80 buckets; their pair becomes a row only in the first table they
share and there in the bucket of their least shared axes, which the axes of both tell (see ``_meet_here``).

Defined results: equal vectors with the same label are one class and link with each other; vectors
that are null, empty, zero or hold a null or non-finite component, and rows without a label or an id,
link with nothing; only vectors of the same length are compared; a row without an id has no component
and is not kept. Rows that share an id are separate vectors. Other columns are ignored, whatever their names.
Very large and very small components are compared like any others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakepipe.llm import graph
from lakepipe.llm.words import mix
from lakepipe.session import written_once


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, unnormalised; the width is a power of two."""
    step = 1
    while step < x.shape[1]:
        y = x.reshape(len(x), -1, 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), -1)
        step *= 2
    return x


def _signs(seed: int, width: int) -> np.ndarray:
    bits = mix(np.arange(width, dtype=np.uint64) + np.uint64(seed * 1_000_003 + 17)) >> np.uint64(63)
    return 1.0 - 2.0 * bits.astype(np.float64)


def nearest_axes(x: np.ndarray, seed: int) -> np.ndarray:
    """For every row the two nearest signed axes after the rotation ``seed``."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    v = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    for turn in range(3):
        v = hadamard(v * _signs(3 * seed + turn, width)) / math.sqrt(width)
    size = np.abs(v)
    first = size.argmax(1)
    rows = np.arange(len(v))
    best = 2 * first + (v[rows, first] > 0)
    size[rows, first] = -1.0
    second = size.argmax(1)
    return np.stack([best, 2 * second + (v[rows, second] > 0)], axis=1)


def axes_of(x: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """(rows, tables, hashes, 2): the two nearest axes of every hash, the smaller number first."""
    found = [nearest_axes(x, seed) for seed in range(tables * hashes)]
    return np.sort(np.stack(found, axis=1), axis=2).reshape(len(x), tables, hashes, 2)


def buckets(x: np.ndarray, salt: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """(rows, tables * 2 ** hashes) bucket numbers; ``salt`` separates labels and lengths."""
    return _buckets(axes_of(x, tables, hashes), salt)


def _buckets(axes: np.ndarray, salt: np.ndarray) -> np.ndarray:
    _, tables, hashes, _ = axes.shape
    out = []
    for table in range(tables):
        for probe in range(2**hashes):
            key = mix(salt + np.uint64(table + 1))
            for h in range(hashes):
                key = mix(key * np.uint64(31) + axes[:, table, h, probe >> h & 1].astype(np.uint64))
            out.append(key)
    return np.stack(out, axis=1)


def _hashed(tables: int, hashes: int):
    """Per node its bucket numbers, table by table and probe by probe, and the two axes of every hash as one number."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                part = batch.slice(begin, 2000)
                lists = part.column("vector")
                sizes = np.diff(lists.offsets.to_numpy())
                node = part.column("node").to_numpy()
                label = part.column("label_key").to_numpy().view(np.uint64)
                flat = lists.flatten().to_numpy()
                for width in np.unique(sizes):
                    rows = np.flatnonzero(sizes == width)
                    starts = np.concatenate([[0], np.cumsum(sizes)])[rows]
                    axes = axes_of(flat[starts[:, None] + np.arange(width)], tables, hashes)
                    found = _buckets(axes, mix(label[rows] + np.uint64(width)))
                    both = (axes[..., 0] << 32 | axes[..., 1]).reshape(len(rows), -1)
                    columns = [_lists(found.view(np.int64)), pa.array(node[rows]), _lists(both)]
                    yield pa.RecordBatch.from_arrays(columns, names=["buckets", "node", "axes"])

    return enter


def _lists(values: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1)))


def _meet_here(tables: int, hashes: int):
    """Whether the bucket of two rows is the one in which their pair is a row.

    Rows have ``axes`` (two numbers per hash, the smaller in the upper half) and ``place``, which of its
    node's buckets the row is: the table, and per hash a bit that is set for the larger axis. Two nodes
    share a table if they share an axis of each of its hashes. Their first table counts, and in it the
    least shared axis of each hash: the larger one of both only if their smaller ones differ.
    """

    def both(x, y, h):
        return F.col(f"{x}.axes")[h], F.col(f"{y}.axes")[h]

    def low(axes):
        return F.shiftright(axes, 32)

    def high(axes):
        return axes.bitwiseAND(0xFFFFFFFF)

    def shared(x, y, table):
        met = F.lit(True)
        for h in range(table * hashes, (table + 1) * hashes):
            a, b = both(x, y, h)
            met &= (low(a) == low(b)) | (high(a) == high(b)) | (low(a) == high(b)) | (high(a) == low(b))
        return met

    def condition(x, y):
        place, other = F.col(f"{x}.place"), F.col(f"{y}.place")
        first = F.coalesce(*[F.when(shared(x, y, t), t) for t in range(tables)])
        least = F.shiftright(place, hashes) == first
        for h in range(hashes):
            at = F.shiftright(place, hashes) * hashes + h
            a, b = both(x, y, at)
            larger = place.bitwiseAND(other).bitwiseAND(1 << h) != 0
            least &= ~(larger & (low(a) == low(b)))
        return least

    return condition


def near_vectors(
    vectors: DataFrame, threshold: float = 0.93, tables: int = 10, hashes: int = 3
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label)."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    largest = F.aggregate("vector", F.lit(0.0), lambda top, v: F.greatest(top, F.abs(v)))
    rows = rows.withColumn("largest", largest)
    # Scaled by a power of two, which is exact, so that no square overflows or vanishes; cosines stay as they are.
    power = F.when(F.col("largest") < float("inf"), -F.floor(F.log2("largest")))
    half = F.floor(power / 2)
    factors = F.struct(F.pow(F.lit(2.0), half).alias("x"), F.pow(F.lit(2.0), power - half).alias("y"))
    # The outer function binds the factors once per row; named in the inner one, they would be found again per component.
    scaled = F.transform(F.array(factors), lambda f: F.transform("vector", lambda v: v * f["x"] * f["y"]))[0]
    rows = rows.withColumn("vector", scaled)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda t, v: t + v * v))
    # A null component makes the norm null; the largest component is 0, NaN or infinite where the others are unusable.
    rows = rows.withColumn("norm", norm)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.col("largest") > 0)
    usable &= F.col("norm").isNotNull() & ~F.isnan("norm") & (F.col("largest") < float("inf"))
    classes = rows.where(usable).groupBy("label", "vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.first("norm").alias("norm")
    )
    classes = written_once(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    keyed = classes.select("node", F.xxhash64("label").alias("label_key"), "vector")
    kinds = "buckets array<bigint>, node long, axes array<bigint>"
    hashed = written_once(keyed.mapInArrow(_hashed(tables, hashes), kinds), "hashed")
    entries = hashed.select("node", F.posexplode("buckets").alias("place", "bucket"))

    def side(name):
        return classes.select(
            F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("label", "vector", "norm", "copies")]
        )

    def with_cosine(pairs):
        dot = F.aggregate(
            F.zip_with("a_vector", "b_vector", lambda x, y: x * y), F.lit(0.0), lambda total, p: total + p
        )
        joined = pairs.join(side("a"), "a").join(side("b"), "b").where("a_label = b_label")
        joined = joined.where(F.size("a_vector") == F.size("b_vector"))
        joined = joined.withColumn("cosine", dot / (F.col("a_norm") * F.col("b_norm")))
        return joined.where(F.col("cosine") >= threshold).select("a", "b", "a_copies", "b_copies", "cosine")

    # First pass: every bucket's vectors against its first one. The margin is far above rounding errors.
    hubs = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("hub")).where("m > 1")
    met = written_once(entries.join(hubs.drop("m"), "bucket"), "met")
    star = met.where("node > hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    star = written_once(with_cosine(star.distinct()), "star")
    inside = math.cos(math.acos(threshold) / 2) + 1e-9
    centres = star.where(F.col("cosine") >= inside).groupBy("a").agg(F.min("b").alias("centre"))
    blocked = classes.select("node", "copies", "least").join(
        centres.select(F.col("a").alias("node"), "centre"), "node", "left"
    )
    blocked = written_once(blocked.withColumn("block", F.coalesce("centre", "node")).drop("centre"), "blocks")
    members = met.join(blocked.select("node", "block"), "node").select("bucket", "node", "block", "place")
    # Second pass: pairs across blocks. A hub and its members meet here too unless they are one block.
    # Each pair is one row; only equal bucket numbers of unlike axes, and a single axis, can repeat it.
    axes = hashed.select("node", "axes")
    pairs = graph.across_blocks(members, _meet_here(tables, hashes), lambda mixed: mixed.join(axes, "node"))
    links = written_once(with_cosine(pairs.distinct()), "links")

    sizes = blocked.groupBy("block").agg(F.sum("copies").alias("together"))
    outside = links.select(F.col("a").alias("node"), F.col("b_copies").alias("other")).union(
        links.select("b", "a_copies")
    )
    outside = outside.groupBy("node").agg(F.sum("other").alias("outside"))
    component = graph.components(
        links.select("a", "b").union(blocked.where("block < node").select(F.col("node").alias("a"), "block"))
    )
    counted = (
        blocked.join(sizes, "block")
        .join(outside, "node", "left")
        .join(component, "node", "left")
        .select(
            "node",
            "least",
            F.coalesce("component", "node").alias("component"),
            (F.col("together") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
        )
    )
    counted = written_once(counted, "counted")
    named = counted.groupBy("component").agg(F.min("least").alias("component_id"))
    found = counted.join(named, "component").join(classes, "node").select("label", "vector", "n_links", "component_id")
    result = rows.select("vec_id", "label", "vector", usable.alias("usable")).alias("r")
    found = found.withColumn("usable", F.lit(True))
    result = result.join(found, ["label", "vector", "usable"], "left")
    component_id = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component_id).alias("component_id"),
        F.coalesce(F.col("vec_id") == component_id, F.lit(False)).alias("kept"),
    )
