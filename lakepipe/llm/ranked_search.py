"""Ranked lexical search: every item against all documents, term at a time with limited accumulators.

The documents are cut into blocks, each an inverted list of its own: per term the documents that hold it
and how often. One pass writes the blocks; sums over them give the numbers of documents and terms and each
term's document frequency, and so its weight. A second pass ranks within each block. An item's terms are
taken rarest first. As long as the rest of its terms could still lift an unseen document to the k-th best
partial score, documents of a term get an accumulator; from then on only documents that have one are
updated, all of them exactly to the end. A term's bound is its weight times the largest factor in the block.
The k-th score of a task's earlier blocks counts as well. Each task returns k documents an item at most,
and these are ranked in two steps, per (item, group of tasks) and per item.

Terms are 64-bit hashes. Only the items' terms are kept in the blocks as long as they are few enough to be
sent to the tasks (``MOST_SENT``), else all terms; both give the same result. The items' weighted terms are
sent to the tasks in groups of items of at most that size, each a pass over the blocks.

Defined results: a null or empty text has no terms; a document without an id counts in the statistics and
is never returned; rows that share an id are ranked each by itself; items that share an id are one item with
all their terms, an item without an id is none; equal scores rank by ascending doc_id, equal ids arbitrarily.
Very long texts are one entry of a block that is read and held whole. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakepipe.llm import store
from lakepipe.llm.words import buffer_of, words_of
from lakepipe.session import written_once

MOST_SENT = 500_000  # hashed terms with their items and weights that are sent to every task, 24 bytes each
BLOCK_POSTINGS, BLOCK_DOCS = 1_000_000, 50_000  # a block is closed by the first text that reaches either
GROUPS = 64  # of tasks, whose best documents are ranked among themselves first

#: What separates terms: all of ASCII but digits and letters.
_BREAKS = np.ones(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _BREAKS[_low : _high + 1] = False


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashed terms of all texts, the text of each, and the number of terms of each text."""
    words = words_of(*buffer_of(texts), breaks=_BREAKS)
    counts = np.diff(words.starts)
    return words.hashes, np.repeat(np.arange(len(texts)), counts), counts


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) once each, for every term of every item with an id."""
    kind = items.schema["item_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in store.chunks(batches, "text", 1_000_000):
            terms, owner, _ = _terms(texts)
            ids = batch.column("item_id").take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([ids, pa.array(terms.view(np.int64))], names=["item_id", "term"])

    named = items.where("item_id IS NOT NULL").select("item_id", "text")
    return named.mapInArrow(split, f"item_id {kind}, term long").distinct()


_BLOCK = "docs long, terms long, n_terms long, ids array<{id}>, sizes array<long>, term array<long>, frequency array<long>, holders binary, times binary"


def _blocks(docs: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """Rows of a block each: ids and sizes of its documents, its sorted terms with the number of documents, and per
    term the documents (their places among ``ids``) and how often they hold it."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, parts, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            size = np.concatenate(sizes)
            term, doc, times = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(term, kind="stable")  # documents stay in order within a term
            term, doc, times = term[order], doc[order], times[order]
            first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
            packed = [store.pack(np.minimum(c, 2**32 - 1).astype(np.uint32)) if len(c) else b"" for c in (doc, times)]
            all_ids = pa.concat_arrays(ids)
            one = pa.array([0, len(size)], pa.int32()), pa.array([0, len(first)], pa.int32())
            fields = {
                "docs": pa.array([int(np.count_nonzero(size))]),
                "terms": pa.array([int(size.sum())]),
                "n_terms": pa.array([len(term)]),
                "ids": pa.ListArray.from_arrays(one[0], all_ids),
                "sizes": pa.ListArray.from_arrays(one[0], pa.array(size)),
                "term": pa.ListArray.from_arrays(one[1], pa.array(term[first].view(np.int64))),
                "frequency": pa.ListArray.from_arrays(one[1], pa.array(np.diff(np.append(first, len(term))))),
                "holders": pa.array([packed[0]], pa.binary()),
                "times": pa.array([packed[1]], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(fields.values()), names=list(fields))

        for batch, texts in store.chunks(batches, "text", 2_000_000):
            terms, owner, counts = _terms(texts)
            if wanted is not None and len(wanted):
                at = np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)
                here = wanted[at] == terms
                terms, owner = terms[here], owner[here]
            elif wanted is not None:
                terms, owner = terms[:0], owner[:0]
            order = np.lexsort((terms, owner))
            terms, owner = terms[order], owner[order]
            new = np.append(True, (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])) if len(terms) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            base = sum(map(len, sizes))
            ids.append(batch.column("doc_id"))
            sizes.append(counts.astype(np.int64))
            parts.append((terms[first], owner[first] + base, np.diff(np.append(first, len(terms)))))
            held += len(first)
            if held >= BLOCK_POSTINGS or base + len(texts) >= BLOCK_DOCS:
                yield block()
                ids, sizes, parts, held = [], [], [], 0
        if ids:
            yield block()

    return docs.select("doc_id", "text").mapInArrow(index, _BLOCK.format(id=kind))


def _slack(sizes: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """100 - 90 + (90 * size * documents) div terms, of each document."""
    if len(sizes) and 90 * int(sizes.max()) * docs >= 2**63:
        return np.array([10 + 90 * int(n) * docs // terms for n in sizes], np.int64)
    return 10 + 90 * sizes * docs // max(1, terms)


def rank_block(
    weights: list[int], bounds: list[int], holders: list[np.ndarray], factors: list[np.ndarray], docs: int, k: int, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """The documents of a block that have an accumulator, and their scores, for one item's terms, rarest first.

    ``holders[i]`` are the places of the documents that hold term i, ``factors[i]`` what each gets for it per unit
    of weight, ``bounds[i]`` the most any gets; ``least`` is a score that k documents are known to reach elsewhere.
    """
    rest, reachable = sum(bounds), 0
    scores, seen = np.zeros(docs, np.int64), np.zeros(docs, bool)
    creating = rest >= least
    for weight, bound, places, factor in zip(weights, bounds, holders, factors, strict=True):
        rest -= bound
        reachable += bound
        gains = weight * factor
        if not creating:
            known = seen[places]
            scores[places[known]] += gains[known]
            continue
        seen[places] = True
        scores[places] += gains
        if rest < reachable:
            partial = scores[seen]
            if len(partial) >= k:
                least = max(least, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
        creating = rest >= least
    found = np.flatnonzero(seen & (scores > 0))
    return found, scores[found]


def _ranked(blocks: DataFrame, group: list, docs: int, terms: int, k: int, item_kind: str) -> DataFrame:
    """(item_id, doc_id, score): at most ``k`` documents an item from each task. ``group``: (item_id, term, weight)."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    items = sorted({row[0] for row in group})
    number = {item: i for i, item in enumerate(items)}
    owner = np.array([number[r[0]] for r in group], np.int64)
    term = np.array([r[1] for r in group], np.int64).view(np.uint64)
    weight = np.array([r[2] for r in group], np.int64)
    order = np.lexsort((term, -weight, owner))  # rarest first within an item
    owner, term, weight = owner[order], term[order], weight[order]
    edges = np.searchsorted(owner, np.arange(len(items) + 1))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, object]]] = [[] for _ in items]
        for batch in batches:
            for row in range(batch.num_rows):
                _rank_row(batch.slice(row, 1), best)
        rows = [(items[i], doc, score) for i, found in enumerate(best) for score, doc in found]
        columns = list(zip(*rows, strict=True)) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["item_id", "doc_id", "score"])

    def _rank_row(row: pa.RecordBatch, best: list) -> None:
        ids = row.column("ids").flatten()
        sizes = row.column("sizes").flatten().to_numpy()
        stored = row.column("term").flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(row.column("frequency").flatten().to_numpy())
        postings = row.column("n_terms")[0].as_py()
        if not len(stored):
            return
        holders = store.unpack(row.column("holders")[0].as_py(), postings, np.uint32).astype(np.int64)
        times = store.unpack(row.column("times")[0].as_py(), postings, np.uint32).astype(np.int64)
        begins = np.append(0, ends[:-1])
        factor = 1_000_000_000 * times // (1000 * times + 8 * _slack(sizes, docs, terms)[holders])
        if ids.null_count:  # counted, never returned
            factor[np.asarray(ids.is_null())[holders]] = 0
        at = np.minimum(np.searchsorted(stored, term), len(stored) - 1)
        present = stored[at] == term
        most = np.maximum.reduceat(factor, begins)
        for i in range(len(items)):
            mine = np.arange(edges[i], edges[i + 1])
            mine = mine[present[mine]]
            if not len(mine):
                continue
            cuts = [slice(begins[j], ends[j]) for j in at[mine]]
            least = best[i][-1][0] if len(best[i]) == k else 1
            found, scores = rank_block(
                weight[mine].tolist(),
                (weight[mine] * most[at[mine]]).tolist(),
                [holders[c] for c in cuts],
                [factor[c] for c in cuts],
                len(sizes),
                k,
                least,
            )
            if len(found) > k:  # and all that tie with the k-th
                enough = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                found, scores = found[enough], scores[enough]
            if len(found):
                rivals = [*best[i], *zip(scores.tolist(), ids.take(pa.array(found)).to_pylist(), strict=True)]
                best[i] = sorted(rivals, key=lambda r: (-r[0], r[1]))[:k]

    schema = f"item_id {item_kind}, doc_id {kind}, score long"
    types = to_arrow_schema(T.StructType.fromDDL(schema)).types
    columns = ["n_terms", "ids", "sizes", "term", "frequency", "holders", "times"]
    return blocks.select(*columns).mapInArrow(rank, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) the ``k`` best of ``docs`` (doc_id, text).

    Only documents with a score above 0 are returned.
    """
    spark: SparkSession = docs.sparkSession
    item_kind = items.schema["item_id"].dataType.simpleString()
    asked = written_once(item_terms(items), "item-terms")
    distinct = asked.select("term").distinct()
    entries = asked.count()
    few = entries <= MOST_SENT or distinct.count() <= MOST_SENT
    wanted = np.sort(np.array([r[0] for r in distinct.collect()], np.int64).view(np.uint64)) if few else None
    blocks = written_once(_blocks(docs, wanted), "blocks")
    total = blocks.agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 0

    held = blocks.select(F.inline(F.arrays_zip("term", "frequency"))).groupBy("term").agg(F.sum("frequency").alias("df"))
    weigh = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * n_docs + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0))))
    weighted = written_once(asked.join(held, "term").select("item_id", "term", weigh.cast("long").alias("weight")), "weighted")

    # Whole items per group; an item of more terms than a group may hold makes its own.
    groups = max(1, math.ceil(2 * entries / MOST_SENT))
    numbered = weighted.withColumn("group", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    groups_held = [r["group"] for r in numbered.select("group").distinct().collect()]
    best = None
    for group in sorted(groups_held):
        sent = numbered.where(F.col("group") == group).select("item_id", "term", "weight").collect()
        found = _ranked(blocks, sent, n_docs, n_terms, k, item_kind)
        best = found if best is None else best.unionByName(found)
    if best is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    order = [F.desc("score"), F.asc("doc_id")]
    near = Window.partitionBy("item_id", "task").orderBy(*order)
    best = best.withColumn("task", F.spark_partition_id() % GROUPS)
    best = best.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    whole = Window.partitionBy("item_id").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
