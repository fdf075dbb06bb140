import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import graph, queries, vector_join
from lakepipe.session import importable_by_workers

SMALL = "/root/testdata/sf0.01"


def brute(rows, threshold=0.93):
    """(n_links, component_id, kept) by row number."""
    usable = []
    for n, (i, v, label) in enumerate(rows):
        good = i is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v)
        if good and any(x != 0 for x in v):
            usable.append(n)
    parent = {n: n for n in range(len(rows))}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    links = dict.fromkeys(parent, 0)
    unit = {n: np.array(rows[n][1], float) / np.linalg.norm(np.array(rows[n][1], float)) for n in usable}
    for k, a in enumerate(usable):
        for b in usable[:k]:
            if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for n in parent:
        if rows[n][0] is not None:
            least[root(n)] = min(least.get(root(n), rows[n][0]), rows[n][0])
    return sorted(
        (str(rows[n][0]), links[n], None if rows[n][0] is None else least[root(n)], rows[n][0] == least.get(root(n), -1))
        for n in parent
    )


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    out = vector_join.near_vectors(frame, **options).collect()
    return sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in out)


def near(rng, centre, cosine):
    noise = rng.normal(size=len(centre))
    noise -= noise @ centre * centre
    return cosine * centre + math.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    out = queries.op7_near_vectors(spark, SMALL).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in out) == brute(rows)


def test_dense_groups_copies_and_strays(spark):
    rng = np.random.default_rng(4)
    rows = []
    for group in range(4):
        centre = rng.normal(size=64)
        centre /= np.linalg.norm(centre)
        for cosine in [0.99] * 15 + [0.96] * 8 + [0.94] * 4 + [0.9] * 3:
            rows.append([float(x) for x in near(rng, centre, cosine).astype(np.float32)])
    rows += rows[:5] + rows[:2]
    rows += [[float(x) for x in rng.normal(size=64).astype(np.float32)] for _ in range(60)]
    table = [(i, v, i % 2 if i < 122 else 0) for i, v in enumerate(rows)]
    random.Random(1).shuffle(table)
    assert found(spark, table) == brute(table)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    table = [
        (1, v, 1), (2, [2.0, 4.0, 6.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [1.0, None, 3.0], 1), (9, [1.0, float("nan"), 3.0], 1), (10, [1.0, float("inf"), 3.0], 1),
        (11, [1.0, 2.0, 3.0, 0.0], 1), (None, v, 1), (12, v, 1), (12, v, 1), (13, [1.0], 5), (14, [3.0], 5), (15, [-3.0], 5),
    ]
    assert found(spark, table) == brute(table)
    assert found(spark, []) == []


def test_transform_is_the_hadamard_matrix():
    h = np.array([[1.0]])
    for _ in range(4):
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(vector_join.hadamard(x), x @ h)


@pytest.mark.parametrize("cosine,least", [(0.93, 0.99), (0.97, 0.999)])
def test_recall_of_the_buckets(cosine, least):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.stack([near(rng, v, cosine) for v in x])
    salt = np.zeros(len(x), np.uint64)
    a, b = (vector_join.buckets(v, salt, 10, 3) for v in (x, y))
    hit = [len(set(p) & set(q)) > 0 for p, q in zip(a.tolist(), b.tolist())]
    assert np.mean(hit) >= least


def test_squares_that_overflow_or_vanish(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=70)
    centre /= np.linalg.norm(centre)
    other = near(rng, centre, 0.5)
    rows = []
    for k, scale in enumerate([1.0, 1e300, 1e-300, 2.0**-1000, 1e308]):
        rows += [(4 * k, near(rng, centre, 0.99) * scale * 0.5, 1), (4 * k + 1, other * scale * 0.5, 1)]
    rows = [(i, [float(x) for x in v], label, "clash") for i, v, label in rows]
    schema = "vec_id long, embedding array<double>, label int, largest string"
    out = vector_join.near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == {r[0]: (4, r[0] % 4) for r in rows}


def loose_cluster(n, cosine):
    """``n`` vectors so far from their centre that few of them share a block."""
    rng = np.random.default_rng(12)
    centre = rng.normal(size=64)
    centre /= np.linalg.norm(centre)
    return [[float(x) for x in near(rng, centre, cosine)] for _ in range(n)]


@pytest.mark.parametrize("tables,hashes,width", [(10, 3, 64), (4, 2, 5), (3, 2, 1)])
def test_a_pair_is_one_row(spark, tables, hashes, width):
    vectors = [v[:width] for v in loose_cluster(300, 0.966)]
    rows = [(node, 7, v) for node, v in enumerate(vectors)]
    frame = importable_by_workers(spark).createDataFrame(rows, "node long, label_key long, vector array<double>")
    kinds = "buckets array<bigint>, node long, axes array<bigint>"
    hashed = frame.mapInArrow(vector_join._hashed(tables, hashes), kinds).cache()
    members = hashed.select("node", "axes", F.posexplode("buckets").alias("place", "bucket")).withColumn("block", F.col("node"))
    members = members.where("node % 10 > 0 OR node = 0").withColumn("block", F.expr("IF(node % 10 < 3, 0, node)"))
    every = [tuple(r) for r in graph.across_blocks(members.drop("axes", "place")).collect()]
    once = [tuple(r) for r in graph.across_blocks(members, vector_join._meet_here(tables, hashes)).collect()]
    assert set(once) == set(every) and len(every) > 2 * len(set(every))
    assert len(once) == len(set(once)) or width == 1


def test_loose_cluster(spark):
    table = [(i, v, 1) for i, v in enumerate(loose_cluster(500, 0.966))]
    got = found(spark, table)
    assert got == brute(table)
    assert sum(links for _, links, _, _ in got) > 100_000
