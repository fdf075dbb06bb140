import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakepipe.llm import queries, ranked_search
from lakepipe.session import importable_by_workers

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=10):
    """(item, rank, doc, score) of lists of (id, text)."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, length = len(held), sum(size for _, _, size in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in wanted if df[t]}
        scored = []
        for doc, c, size in held:
            m = 10 + 90 * size * n // length
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weight.items() if c[t])
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def made(seed, docs=300, items=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(80)]
    weights = [1 / (i + 1) for i in range(80)]

    def text(most):
        return " ".join(rng.choices(words, weights, k=rng.randint(0, most)))

    return [(i, text(60)) for i in range(docs)], [(i, text(12)) for i in range(items)]


def frames(spark, docs, items):
    importable_by_workers(spark)
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("sent,block", [(500_000, 50_000), (500_000, 7), (20, 40), (0, 7)])
def test_against_brute_force(spark, monkeypatch, sent, block):
    """Also when the terms are too many to be sent at once, and in blocks of a few documents."""
    monkeypatch.setattr(ranked_search, "MOST_SENT", max(1, sent))
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    docs, items = made(block)
    if sent < 100:
        items = items[:6]
    assert rows_of(ranked_search.search(*frames(spark, docs, items))) == brute(docs, items)


def test_ties_copies_nulls_and_clashing_columns(spark):
    docs = [(i, "same words here") for i in range(40)] + [(100, None), (101, ""), (102, "***"), (None, "same words here")]
    docs += [(7, "same words here"), (103, "Ünïcode WORDS 日本 here's"), (104, "words " * 50_000)]
    items = [(1, "same WORDS"), (2, None), (3, ""), (4, "absent terms only"), (None, "same"), (5, "日本 here"), (5, "words"), (6, "same same same")]
    d, i = frames(spark, docs, items)
    clash = d.selectExpr("doc_id", "text", "'x' AS item_id", "1 AS score", "2 AS term", "3 AS rank")
    got = rows_of(ranked_search.search(clash, i.selectExpr("*", "1 AS doc_id", "2 AS weight")))
    assert got == brute(docs, items)
    assert [r[2] for r in got if r[0] == 1][:9] == [0, 1, 2, 3, 4, 5, 6, 7, 7]


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert ranked_search.search(docs.where("false"), items).count() == 0
    assert ranked_search.search(docs, items.where("false")).count() == 0
    assert ranked_search.search(docs, items.withColumn("text", items["text"].substr(9, 1))).count() == 0


def test_accumulators_are_limited_and_survivors_exact():
    """Once the rest cannot lift an unseen document, the frequent term creates no accumulator and still counts."""
    rare, frequent = np.arange(3), np.arange(100)
    factors = [np.full(3, 500_000), np.full(100, 400_000)]
    found, scores = ranked_search.rank_block([9000, 10], [9000 * 500_000, 10 * 400_000], [rare, frequent], factors, 100, 3, 1)
    assert found.tolist() == [0, 1, 2] and set(scores.tolist()) == {9000 * 500_000 + 10 * 400_000}
    found, _ = ranked_search.rank_block([9000, 10], [9000 * 500_000, 10 * 400_000], [rare, frequent], factors, 100, 4, 1)
    assert len(found) == 100


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows_of(queries.op13_ranked_search(spark, folder)) == brute(docs, items)
