import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import quality_model, queries
from lakepipe.llm.words import buffer_of, words_of

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.op9_quality_scores(spark, SMALL)
    assert rows.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert rows.where("score NOT BETWEEN 0 AND 1 OR predicted <> CAST(score >= 0.3 AS INT)").isEmpty()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    held = rows.where("held_out").join(labels, "doc_id").collect()
    right = [r["predicted"] == r["quality"] for r in held]
    assert np.mean(right) > 0.9
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_pairwise_term_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    cuts = np.sort(rng.normal(size=(len(quality_model.STATISTICS), quality_model.BINS)), axis=1)
    size = quality_model.BUCKETS + len(quality_model.STATISTICS) * (quality_model.BINS + 1)
    low_rank = rng.normal(0, 0.1, (size, quality_model.RANK)).astype(np.float32)
    model = quality_model.Model(cuts, 0.3, rng.normal(0, 0.1, size), low_rank)
    texts = [b"", b"a few words of text", b"words words WORDS!!\nand *** more"]
    buckets, weight, starts, statistics = quality_model.features(texts)
    for k, score in enumerate(model.scores(texts)):
        index = [*buckets[starts[k] : starts[k + 1]], *model.bins(statistics)[k]]
        value = [*weight[starts[k] : starts[k + 1]], *[1.0] * len(quality_model.STATISTICS)]
        y = model.bias + sum(model.linear[i] * x for i, x in zip(index, value))
        for a in range(len(index)):
            for b in range(a):
                y += float(low_rank[index[a]].astype(float) @ low_rank[index[b]].astype(float)) * value[a] * value[b]
        assert score == pytest.approx(1 / (1 + np.exp(-y)), rel=1e-4)


def described(text):
    """The features of one text without arrays: {bucket: weight} and the statistics."""
    data = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in data))
    of = [int(words_of(*buffer_of([w])).hashes[0]) for w in words]
    often = Counter(h % quality_model.BUCKETS for h in of)
    weight = {b: 1 + math.log(n) for b, n in often.items()}
    norm = math.sqrt(max(sum(w * w for w in weight.values()), 1e-12))
    size, n = max(1, len(data)), max(1, len(words))
    shares = [sum(c in chars for c in data) / size for chars in quality_model.CLASSES.values()]
    return {b: w / norm for b, w in weight.items()}, [
        *shares,
        math.log1p(len(data)),
        math.log1p(len(words)),
        sum(map(len, words)) / n,
        sum(a == b for a, b in zip(of, of[1:])) / n,
        len(weight) / n,
        len(words) / (data.count(b"\n") + 1),
    ]


def test_query_against_brute_force_scores(spark):
    """Every score of the query as the sum over all pairs of features, with features counted text by text."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    usable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = quality_model.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), usable)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = queries.op9_quality_scores(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        weight, statistics = described(texts[r["doc_id"]])
        bins = [
            quality_model.BUCKETS + k * (quality_model.BINS + 1) + sum(cut < s - 1e-12 for cut in cuts)
            for k, (cuts, s) in enumerate(zip(model.cuts, statistics))
        ]
        index, value = [*weight, *bins], np.array([*weight.values(), *[1.0] * len(bins)])
        vectors = model.low_rank[index].astype(float) * value[:, None]
        products = vectors @ vectors.T
        y = model.bias + float(model.linear[index] @ value) + float(np.triu(products, 1).sum())
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-y)), abs=1e-4)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_sample_of_the_smallest_hashes(spark, monkeypatch):
    known = spark.range(5000).withColumnRenamed("id", "doc_id")
    for most in (0, 1, 700, 4999, 5000, 9000):
        monkeypatch.setattr(quality_model, "HASH_BITS", 2 if most == 700 else 14)
        ids = {r[0] for r in quality_model._smallest_hashes(known, most).collect()}
        order = [r[0] for r in known.orderBy(F.expr("shiftrightunsigned(xxhash64(doc_id), 22)"), "doc_id").collect()]
        assert ids == set(order[: len(ids)]) and min(most, 5000) - (350 if most == 700 else 5) <= len(ids) <= most


def test_text_alone_decides(spark):
    """Other ids, languages and sources do not change a score."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(50)
    model = quality_model.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), F.lit(True))
    before = sorted(r["score"] for r in quality_model.score(docs, model).collect())
    other = docs.withColumns({"doc_id": F.col("doc_id") + 7, "lang": F.lit("xx"), "source": F.lit("y")})
    assert sorted(r["score"] for r in quality_model.score(other, model).collect()) == before


def test_the_sample_is_bounded_and_repeatable(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    a, b = (quality_model.train(docs.repartition(n), labels, F.lit(True), 100) for n in (1, 5))
    assert np.array_equal(a.low_rank, b.low_rank) and np.array_equal(a.linear, b.linear) and a.bias == b.bias


def test_odd_rows(odd_docs, no_docs, odd_labels):
    model = quality_model.train(odd_docs, odd_labels, F.lit(True))
    rows = quality_model.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (0, 1)}) == 1
    untaught = quality_model.train(odd_docs, odd_labels.where("false"), F.lit(True))
    assert {round(r["score"], 1) for r in quality_model.score(odd_docs, untaught).collect()} == {0.5}
    assert quality_model.score(no_docs, model).count() == 0
    kept = quality_model.keep_good(odd_docs, odd_labels, F.lit(True), threshold=0.0)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count()
