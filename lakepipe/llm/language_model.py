"""Interpolated modified Kneser-Ney n-gram model, counted in Spark and memory-mapped by the workers.

The order n is a parameter. The model's parts are sorted hash arrays in the shared folder: the words with
their count and number (see ``store``), and per level k the grams of k words (see ``gram_arrays``). At level n
a gram has its count, below it the number of different words seen before it; below n it also has, as a
context of the level above, the sum of the counts that follow and how many of them are 1, 2 and more. Every
text is preceded by n - 1 begin marks, which are contexts only, and closed by an end mark, which is a token.

p_k(w | u) = max(c(uw) - D(c(uw)), 0) / c(u) + (D1 n1(u) + D2 n2(u) + D3 n3(u)) / c(u) * p_k-1(w | u without its
first word), where c are the counts of level k and u has k - 1 words; where u was not seen, p_k is p_k-1. p_0 is
uniform over the V known tokens and one unknown token.

Grams are merged by the hash of all their words, so a frequent word or pair is no task of its own; what a
gram says about its context and its ending goes on as one sum per shard. No gram is pruned.

Defined results: a null text is empty and has the end mark as its only token; with nothing to learn
from, every token has the probability 1 / (V + 1) = 1; rows without an id, or with one that another
row has as well, are scored each by its own text. A row without an id is not held out. Input columns other
than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakepipe.llm import gram_arrays, store
from lakepipe.llm.words import buffer_of, words_of

#: Words of the longest gram.
ORDER = 3
END = np.uint64(0xE0E0E0E0E0E0E0E1)
#: Numbers of the begin mark and of words that were never counted; counted words have larger ones.
BEGIN, UNKNOWN = 0, 1
#: Of a level: grams counted once, twice, three and four times, more than twice; sum of counts; shards.
TOTALS = 7


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every text's words and its end mark as hashes, and where each text begins; the end is appended."""
    words = words_of(*buffer_of(texts))
    counts = np.diff(words.starts)
    starts = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int64)
    tokens = np.empty(starts[-1], np.uint64)
    ends = starts[1:] - 1
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner], tokens[ends] = words.hashes, END
    return tokens, starts


def _grams(numbers: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """The words' numbers and before them the ``order`` - 1 words to their left, oldest first."""
    columns = [numbers]
    for _ in range(order - 1):
        left = np.concatenate([np.array([BEGIN], np.uint64), columns[0][:-1]])
        left[starts[:-1]] = BEGIN
        columns.insert(0, left)
    return columns


def _once(level: int, order: int) -> tuple[int, ...]:
    """The values of a gram that occurs once: its count, below the order also its facts as a context."""
    return (1,) if level == order else (1, 1, 1, 0, 0)


def _count_words(texts: DataFrame, bits: int, folder: str) -> tuple[int, int]:
    """Writes the words with their counts and numbers, small numbers for frequent ones; returns N and V."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in store.chunks(batches, "text", 16_000_000):
            words, counts = np.unique(_tokens(part)[0], return_counts=True)
            shards, edges = store.shard_edges(words, bits)
            rows = [
                {
                    "shard": int(shard),
                    "n": int(hi - lo),
                    "words": store.pack_sorted(words[lo:hi]),
                    "counts": store.pack(counts[lo:hi].astype(np.uint32)),
                }
                for shard, lo, hi in zip(shards, edges[:-1], edges[1:], strict=True)
            ]
            kinds = [("shard", pa.int32()), ("n", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words = np.concatenate([store.unpack_sorted(r["words"], r["n"]) for r in rows])
        counts = np.concatenate([store.unpack(r["counts"], r["n"], np.uint32) for r in rows])
        words, counts, _ = store.summed(words, counts)
        rank = np.empty(len(words), np.uint64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(1, len(words) + 1, dtype=np.uint64)
        shard = rows[0]["shard"]
        store.save(folder, shard, word=words, count=counts, number=(rank << np.uint64(bits)) | np.uint64(shard))
        row = {"tokens": int(counts.sum()), "kinds": len(words), "shards": 1}
        return pa.Table.from_pylist([row], pa.schema([(k, pa.int64()) for k in row]))

    partial = texts.mapInArrow(count, "shard int, n long, words binary, counts binary")
    written = partial.groupBy("shard").applyInArrow(merge, "tokens long, kinds long, shards long")
    found = written.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "kinds", "shards")]).first()
    store.seal(folder, found["shards"], "word")
    return found["tokens"], found["kinds"]


def _count_level(level: int, order: int, bits: int, folder: str) -> Callable[[pa.Table], pa.Table]:
    """Merges a shard of one level, writes it, and returns what it says about the grams of the level below."""
    once = _once(level, order)

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        totals = np.sum([r["totals"] for r in rows if r["totals"]] or [[0] * TOTALS * order], axis=0)
        keys, columns, values = gram_arrays.summed(*gram_arrays.unpacked(rows, level, len(once)))
        gram_arrays.save(folder, level, rows[0]["shard"], bits, keys, values, once)
        counts = values[0]
        sizes = [*((counts == k).sum() for k in (1, 2, 3, 4)), (counts > 2).sum(), counts.sum(), 1]
        totals[(level - 1) * TOTALS : level * TOTALS] += np.array(sizes, np.int64)
        totals = [int(t) for t in totals]
        if level == 1:
            return pa.Table.from_pylist([{"totals": totals}], pa.schema([("totals", pa.list_(pa.int64()))]))
        own = counts > 0  # a gram of begin marks is a context only
        counts, columns = counts[own], [c[own] for c in columns]
        zero = np.zeros(len(counts), np.int64)
        facts = [np.concatenate([zero + 1, zero])]
        facts += [np.concatenate([zero, f]) for f in (counts, counts == 1, counts == 2, counts > 2)]
        ends = [np.concatenate(pair) for pair in zip(columns[1:], columns[:-1], strict=True)]
        below = gram_arrays.packed(ends, facts, bits) or [{"shard": 0, "n": 0, "columns": [], "values": []}]
        below[0]["totals"] = totals
        return pa.Table.from_pylist(below, gram_arrays.schema(TOTALS))

    return merge


def _count_grams(texts: DataFrame, order: int, bits: int, folder: str) -> np.ndarray:
    """Writes the arrays of all levels; returns their totals, a row per level."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = store.Shards(folder, bits, "word", sealed=True)
        for _, part in store.chunks(batches, "text", 16_000_000):
            tokens, starts = _tokens(part)
            kinds, at = np.unique(tokens, return_inverse=True)
            numbers = words.find(kinds, ("number", np.uint64, UNKNOWN))[0][at]
            rows = gram_arrays.packed(_grams(numbers, starts, order), [np.ones(len(tokens), np.int64)], bits)
            yield pa.RecordBatch.from_pylist(rows, gram_arrays.schema(TOTALS))

    kind = "shard int, n long, columns array<binary>, values array<binary>, totals array<long>"
    rows = texts.mapInArrow(count, kind)
    for level in range(order, 0, -1):
        merge = _count_level(level, order, bits, folder)
        rows = rows.groupBy("shard").applyInArrow(merge, kind if level > 1 else "totals array<long>")
    sums = [F.coalesce(F.sum(F.col("totals")[k]), F.lit(0)).alias(f"t{k}") for k in range(order * TOTALS)]
    totals = np.array(rows.agg(*sums).first(), np.int64).reshape(order, TOTALS)
    for level in range(1, order + 1):
        store.seal(folder, int(totals[level - 1, -1]), f"grams{level}")
    return totals


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """The three discounts from counts of counts; where one is missing or out of range, that of plain Kneser-Ney or 1/2."""
    y = n1 / (n1 + 2 * n2) if n1 > 0 else 0.5
    raw = (
        1 - 2 * y * n2 / n1 if n1 > 0 and n2 > 0 else y,
        2 - 3 * y * n3 / n2 if n2 > 0 and n3 > 0 else y,
        3 - 4 * y * n4 / n3 if n3 > 0 and n4 > 0 else y,
    )
    return tuple(min(max(d, 0.0), k + 0.999) if d > 0 else min(y, 0.999) for k, d in enumerate(raw))


def _less(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    cut = np.where(counts > 2, d[2], np.where(counts == 2, d[1], d[0]))
    return np.maximum(counts - cut, 0.0)


def score_texts(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """Scores every row of ``docs`` (doc_id, text); the model learns from the rows that are not ``held_out``.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. ``base_score`` is
    the text's log10 probability under add-one word frequencies, ``score`` under the model of grams of
    up to ``order`` words.
    """
    if order < 1:
        raise ValueError(f"order must be 1 at least, not {order}")
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    bits = store.shard_bits(docs) + 1
    folder = store.shared_folder(spark, "language-model")
    training = docs.where("NOT held_out").select("text")
    n, v = _count_words(training, bits, folder)
    totals = _count_grams(training, order, bits, folder)
    cuts = [discounts(*map(float, t[:4])) for t in totals]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = store.Shards(folder, bits, "word", sealed=True)
        levels = [gram_arrays.Grams(folder, k, bits, _once(k, order)) for k in range(1, order + 1)]
        for batch, texts in store.chunks(batches, "text", 8_000_000):
            tokens, starts = _tokens(texts)
            kinds, at = np.unique(tokens, return_inverse=True)
            count, number = words.find(kinds, "count", ("number", np.uint64, UNKNOWN))
            count, columns = count[at], _grams(number[at], starts, order)
            p = np.full(len(tokens), 1 / (v + 1))
            ones, twos, _, _, often, whole, _ = totals[0].astype(float)  # the context of a single word is empty
            heads = starts[:-1]
            for level, (grams, cut) in enumerate(zip(levels, cuts, strict=True), start=1):
                keys = gram_arrays.keys_of(columns[-level:])
                begin = gram_arrays.keys_of([np.array([BEGIN], np.uint64)] * level)
                keys, at = np.unique(np.concatenate([begin, keys]), return_inverse=True)
                found = grams.find(keys)
                c = found[0][at[1:]]
                left = cut[0] * ones + cut[1] * twos + cut[2] * often
                p = np.where(whole > 0, (_less(c, cut) + left * p) / np.maximum(whole, 1), p)
                if level < order:  # the context of the level above is this level's gram that ends one word before
                    at = at[:-1]
                    at[heads] = np.searchsorted(keys, begin[0])
                    _, whole, ones, twos, often = found[:, at]
            base = np.log10((count + 1) / (n + v + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(np.diff(starts)),
                    pa.array(np.add.reduceat(count > 0, heads, dtype=np.int64)),
                    pa.array(np.full(len(heads), n, np.int64)),
                    pa.array(np.add.reduceat(base, heads)),
                    pa.array(np.add.reduceat(np.log10(p), heads)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        score,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
