"""Quality classifier: a factorisation machine over hashed words, structure statistics and text length.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pairwise term is computed in linear
time as half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2 over the low-rank vectors. Features are the words'
hash buckets, weighted by damped frequency and scaled to length one, and one bin for each statistic of
the text's structure and its length, so that a pair of statistics, or a statistic and a word, can weigh
together. Labels, language, source and ids are no features.

The model learns from at most ``most_rows`` labelled documents, those with the smallest hashes of their
ids (whole ranges of hashes, so a few less); the sample is gathered in one task, the model (``BUCKETS`` + bins, ``RANK`` numbers each) is of fixed
size. All documents are scored.

Defined results: a null text is empty and is scored like an empty one; a document with contradicting
labels is not learnt from, nor is one whose label is null; without any label every score is 0.5; with one
class only, the score tends to that class. Rows that share an id are scored each by its own text, whole
whatever its length. Other columns are no features, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakepipe.llm import store
from lakepipe.llm.words import buffer_of, words_of

BUCKETS, BINS, RANK = 1 << 15, 16, 8
MOST_ROWS = 16_000

# Classes of bytes whose shares describe a text's structure.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>@^~=+_\\/{}[]",
    "loud": b"!?",
    "stop": b".,;:",
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
}
STATISTICS = [*CLASSES, "length", "words", "word_length", "repeated", "distinct", "words_per_line"]
_MEMBER = np.zeros((len(CLASSES), 256), np.int64)
for _k, _bytes in enumerate(CLASSES.values()):
    _MEMBER[_k, list(_bytes)] = 1


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, weights, where each text begins in them, statistics (texts, STATISTICS))."""
    data, begins = buffer_of(texts)
    words = words_of(data, begins)
    n = np.diff(words.starts)
    size = np.maximum(1, np.diff(begins) - 1)
    owner = np.repeat(np.arange(len(texts)), n)
    code = owner * BUCKETS + (words.hashes % np.uint64(BUCKETS)).astype(np.int64)
    code, often = np.unique(code, return_counts=True)
    starts = np.searchsorted(code, np.arange(len(texts) + 1) * BUCKETS)
    weight = 1 + np.log(often)
    norm = np.sqrt(np.maximum(np.bincount(code // BUCKETS, weight**2, len(texts)), 1e-12))
    weight /= norm[code // BUCKETS]
    shares = [np.add.reduceat(member[data], begins[:-1]) for member in _MEMBER]
    same = np.zeros(len(words.hashes), np.int64)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    some = np.maximum(1, n)
    lines = shares[list(CLASSES).index("line")] + 1
    shares[list(CLASSES).index("space")] -= 1  # the separator after each text in the buffer
    statistics = np.stack(
        [
            *[s / size for s in shares],
            np.log1p(np.diff(begins) - 1),
            np.log1p(n),
            np.bincount(owner, words.length, len(texts)) / some,
            np.bincount(owner, same, len(texts)) / some,
            np.diff(starts) / some,
            n / lines,
        ],
        axis=1,
    )
    return code % BUCKETS, weight, starts, statistics


class Model:
    """Weights of the factorisation machine; ``cuts`` are the bins' borders, one row per statistic."""

    def __init__(self, cuts: np.ndarray, bias: float, linear: np.ndarray, low_rank: np.ndarray):
        self.cuts, self.bias, self.linear, self.low_rank = cuts, bias, linear, low_rank

    def bins(self, statistics: np.ndarray) -> np.ndarray:
        """The feature number of each statistic's bin."""
        cell = [np.searchsorted(c, s, side="left") for c, s in zip(self.cuts, statistics.T, strict=True)]
        return BUCKETS + np.arange(len(cell)) * (BINS + 1) + np.stack(cell, axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        buckets, weight, starts, statistics = features(texts)
        dense = self.bins(statistics)
        x = weight.astype(np.float32)[:, None] * self.low_rank[buckets]
        total = _sums(x, starts) + self.low_rank[dense].sum(1)
        squares = _sums(x * x, starts) + (self.low_rank[dense] ** 2).sum(1)
        linear = _sums((weight * self.linear[buckets])[:, None], starts)[:, 0] + self.linear[dense].sum(1)
        y = self.bias + linear + 0.5 * (total**2 - squares).sum(1, dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows from one start to the next; an empty range sums to zero."""
    out = np.zeros((len(starts) - 1, values.shape[1]))
    some = np.flatnonzero(starts[1:] > starts[:-1])
    if len(some):
        out[some] = np.add.reduceat(values, starts[some], axis=0, dtype=np.float64)
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], statistics: np.ndarray, labels: np.ndarray, turns: int = 6) -> Model:
    """Trains on (buckets, weights) per document with AdaGrad; the same rows in the same order give the same model."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:]
    cuts = np.quantile(statistics, quantiles, axis=0).T if len(labels) else np.zeros((len(STATISTICS), BINS))
    size = BUCKETS + len(STATISTICS) * (BINS + 1)
    rng = np.random.default_rng(7)
    model = Model(cuts, 0.0, np.zeros(size), rng.normal(0, 0.02, (size, RANK)))
    if not len(labels):
        return model
    dense = model.bins(statistics)
    rate = np.clip(labels.mean(), 0.01, 0.99)
    model.bias = float(np.log(rate / (1 - rate)))
    seen_w, seen_v, decay, step = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-5, 0.05
    for _ in range(turns):
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), 128):
            batch = order[begin : begin + 128]
            index = np.concatenate([np.concatenate([rows[i][0], dense[i]]) for i in batch])
            value = np.concatenate([np.concatenate([rows[i][1], np.ones(dense.shape[1])]) for i in batch])
            ends = np.cumsum([len(rows[i][0]) + dense.shape[1] for i in batch])
            starts = np.concatenate([[0], ends])
            owner = np.repeat(np.arange(len(batch)), np.diff(starts))
            x = value[:, None] * model.low_rank[index]
            total = np.add.reduceat(x, starts[:-1], axis=0)
            y = model.bias + np.add.reduceat(value * model.linear[index], starts[:-1])
            y += 0.5 * (total**2 - np.add.reduceat(x * x, starts[:-1], axis=0)).sum(1)
            error = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[batch]) / len(batch)
            model.bias -= step * float(error.sum())
            touched, at = np.unique(index, return_inverse=True)
            pull = error[owner] * value
            grad_w = np.bincount(at, pull) + decay * model.linear[touched]
            grad_v = pull[:, None] * (total[owner] - x)
            grad_v = np.stack([np.bincount(at, g) for g in grad_v.T], axis=1) + decay * model.low_rank[touched]
            seen_w[touched] += grad_w**2
            seen_v[touched] += grad_v**2
            model.linear[touched] -= step * grad_w / np.sqrt(seen_w[touched])
            model.low_rank[touched] -= step * grad_v / np.sqrt(seen_v[touched])
    model.low_rank = model.low_rank.astype(np.float32)
    return model


def _rows_of(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column as views of its values."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[lo:hi] for lo, hi in zip(ends[:-1], ends[1:], strict=True)]


HASH_BITS = 14  # that number the ranges in which labelled ids are counted


def _smallest_hashes(known: DataFrame, most_rows: int) -> DataFrame:
    """The rows of ``known`` in the ranges of id hashes, from the first on, that hold ``most_rows`` together at most.

    The ids are counted per range, so the ranges to take are known before any row is gathered. Where not even the
    first range fits, it is cut into ranges itself.
    """
    for bits in range(HASH_BITS, 64, HASH_BITS):
        place = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits)
        counted = known.groupBy(place.alias("range")).agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy(F.lit(0)).orderBy("range")  # of at most 2 ** HASH_BITS short rows
        placed = counted.withColumn("upto", F.sum("n").over(upto))
        over = F.min(F.when(F.col("upto") > most_rows, F.col("range")))
        least, first = placed.agg(F.min("range"), over).first()
        if first is None:
            return known
        if first > least:
            return known.where(place < first)
        known = known.where(place == least)
    return known.where("false")


def train(docs: DataFrame, labels: DataFrame, usable: Column, most_rows: int = MOST_ROWS) -> Model:
    """Learns ``quality`` of ``labels`` (doc_id, quality) from the texts of ``docs``; ``usable`` tells which ids may be learnt from."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(usable).groupBy("doc_id")
    known = known.agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other")
    chosen = _smallest_hashes(known.select("doc_id", "label"), most_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``most_rows`` short rows

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in store.chunks(batches, "text", 1_000_000):
            buckets, weight, starts, statistics = features(texts)
            ends = pa.array(starts.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.string()),
                    batch.column("label").cast(pa.int32()),
                    pa.ListArray.from_arrays(ends, pa.array(buckets.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(weight.astype(np.float32))),
                    pa.array(list(statistics), pa.list_(pa.float64())),
                ],
                names=["doc_id", "label", "buckets", "weights", "statistics"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b, *(_rows_of(b.column(c)) for c in ("buckets", "weights", "statistics"))) for b in batches]
        ids = [i for b, *_ in parts for i in b.column("doc_id").to_pylist()]
        buckets, weights, described = ([r for p in parts for r in p[k]] for k in (1, 2, 3))
        # Rows that share an id come in the order of their contents, not of their arrival.
        order = sorted(range(len(ids)), key=lambda k: (ids[k], len(buckets[k]), zlib.crc32(buckets[k].tobytes())))
        labels = np.concatenate([np.zeros(0), *[b.column("label").to_numpy() for b, *_ in parts]])
        rows = [(buckets[k], weights[k]) for k in order]
        statistics = np.array([described[k] for k in order]).reshape(-1, len(STATISTICS))
        target = (labels[order] == 1).astype(np.float64)
        model = fit(rows, statistics, target)
        parts = [model.cuts, np.array([model.bias]), model.linear, model.low_rank.astype(np.float32)]
        yield pa.RecordBatch.from_pylist([{"parts": [p.tobytes() for p in parts]}], pa.schema([("parts", pa.list_(pa.binary()))]))

    described = sample.mapInArrow(
        describe, "doc_id string, label int, buckets array<int>, weights array<float>, statistics array<double>"
    )
    found = described.repartition(1).mapInArrow(learn, "parts array<binary>").collect()
    if not found:
        return fit([], np.zeros((0, len(STATISTICS))), np.zeros(0))
    cuts, bias, linear, low_rank = found[0]["parts"]
    return Model(
        np.frombuffer(cuts).reshape(len(STATISTICS), BINS),
        float(np.frombuffer(bias)[0]),
        np.frombuffer(linear),
        np.frombuffer(low_rank, np.float32).reshape(-1, RANK),
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in store.chunks(batches, "text", 1_000_000):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shared.value.scores(texts))], names=["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, usable: Column, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, usable))
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in store.chunks(batches, "text", 1_000_000):
            yield batch.filter(pa.array(model.value.scores(texts) >= threshold))

    return docs.select(*columns).mapInArrow(run, docs.schema)
