import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import language_model, queries
from test_ngram_join import FOLD

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD)), "</s>"]


class Brute:
    """The model by its definition, from dictionaries of tuples."""

    def __init__(self, texts, order=language_model.ORDER):
        self.order, self.count = order, Counter()
        self.levels = [Counter() for _ in range(order)]
        for text in texts:
            t = tokens(text)
            self.count.update(t)
            self.levels[-1].update(self.grams(t))
        for k in range(order - 1, 0, -1):
            self.levels[k - 1].update(g[1:] for g in self.levels[k])
        self.n, self.v = sum(self.count.values()), len(self.count)
        of = lambda c: language_model.discounts(*[sum(x == j for x in c.values()) for j in (1, 2, 3, 4)])
        self.cuts = [of(c) for c in self.levels]
        self.contexts = [defaultdict(list) for _ in range(order)]
        for contexts, level in zip(self.contexts, self.levels):
            for g, k in level.items():
                contexts[g[:-1]].append(k)
        self.facts = [
            {u: (sum(ks), sum(cut[min(k, 3) - 1] for k in ks)) for u, ks in contexts.items()}
            for contexts, cut in zip(self.contexts, self.cuts)
        ]

    def grams(self, t):
        t = ["<s>"] * (self.order - 1) + t
        return [tuple(t[i : i + self.order]) for i in range(len(t) - self.order + 1)]

    def p(self, *gram):
        p = 1 / (self.v + 1)
        for k, (level, cut, facts) in enumerate(zip(self.levels, self.cuts, self.facts), start=1):
            g = gram[len(gram) - k :]
            if g[:-1] in facts:
                whole, left = facts[g[:-1]]
                c = level[g]
                p = (max(c - cut[min(c, 3) - 1], 0) if c else 0) / whole + left / whole * p
        return p

    def scores(self, text):
        t = tokens(text)
        base = sum(math.log10((self.count[w] + 1) / (self.n + self.v + 1)) for w in t)
        return base, sum(math.log10(self.p(*g)) for g in self.grams(t))


def test_scores_as_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in (d["doc_id"] for d in docs)}
    learnt = [d["text"] for d in docs if not out[d["doc_id"]]]
    model = Brute(learnt)
    first, second = model.grams(tokens(learnt[0]))[3][:2]
    for context in [("<s>", "<s>"), ("<s>", first), (first, second), ("?", "the"), ("?", "?")]:
        assert sum(model.p(*context, w) for w in model.count) + model.p(*context, "?") == pytest.approx(1)
    texts = {d["doc_id"]: d["text"] for d in docs}
    rows = queries.op2_kneser_ney_scores(spark, SMALL).collect()
    assert len(rows) == len(docs)
    held, base = 0.0, 0.0
    for r in rows:
        want = model.scores(texts[r["doc_id"]])
        t = tokens(texts[r["doc_id"]])
        assert (r["base_score"], r["score"]) == pytest.approx(want, rel=1e-6)
        assert r["held_out"] == out[r["doc_id"]] and r["train_tokens"] == model.n
        assert (r["n_tokens"], r["n_known"]) == (len(t), sum(model.count[w] > 0 for w in t))
        if r["held_out"]:
            held, base = held + r["score"], base + r["base_score"]
    assert held > base  # the model beats word frequencies on texts it has not seen


@pytest.mark.parametrize("order", [1, 2, 4])
def test_every_order_as_by_brute_force(odd_docs, order):
    texts = [r["text"] for r in odd_docs.collect()]
    model = Brute(texts, order)
    rows = language_model.score_texts(odd_docs, F.lit(False), order).collect()
    known = [r["score"] for r in rows]
    assert sorted(known) == pytest.approx(sorted(model.scores(t)[1] for t in texts), rel=1e-6)


def test_longer_grams_tell_held_out_texts_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    sums = []
    for order in (1, 2, 3):
        scored = language_model.score_texts(docs, held, order)
        sums.append(scored.where("held_out").agg(F.sum("score")).first()[0])
    assert sums[0] < sums[1] < sums[2]


def test_large_counts_and_equal_beginnings(tmp_path):
    bits, once = 5, (1, 1, 1, 0, 0)
    keys = np.sort(np.concatenate([np.arange(40, dtype=np.uint64) << np.uint64(19), [np.uint64(2**59 - 1)]]))
    values = [np.array([1] * 41), np.array([1] * 41), np.array([1] * 41), np.zeros(41, int), np.zeros(41, int)]
    values[0][3], values[1][4], values[2][5] = 200, 70_000, 2**40
    language_model.gram_arrays.save(str(tmp_path), 2, 0, bits, keys, values, once)
    language_model.store.seal(str(tmp_path), 1, "grams2")
    found = language_model.gram_arrays.Grams(str(tmp_path), 2, bits, once).find(keys)
    assert (found == np.array(values)).all()
    absent = language_model.gram_arrays.Grams(str(tmp_path), 2, bits, once).find(keys[:-1] + np.uint64(1 << 40))
    assert not absent.any()


def test_odd_rows(odd_docs, no_docs):
    rows = language_model.score_texts(odd_docs, F.lit(False)).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["score"] < 0 and r["base_score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2)} == {1}
    assert language_model.score_texts(no_docs, F.lit(False)).count() == 0
    nothing = language_model.score_texts(odd_docs, F.lit(True)).collect()
    assert {(r["score"], r["train_tokens"], r["n_known"]) for r in nothing} == {(0.0, 0, 0)}


def test_what_is_gathered_grows_with_the_corpus(spark, tmp_path):
    sizes = []
    for n in (50, 150):
        docs = spark.read.parquet(f"{SMALL}/documents.parquet").where(f"doc_id < {n}").select("text")
        bits = language_model.store.shard_bits(docs)
        folder = tmp_path / str(n)
        folder.mkdir()
        language_model._count_words(docs, bits, str(folder))
        totals = language_model._count_grams(docs, 3, bits, str(folder))
        sizes.append((totals[2, 5], sum(p.stat().st_size for p in folder.iterdir())))
    assert sizes[1][0] > 2 * sizes[0][0] and sizes[1][1] > 1.8 * sizes[0][1]
