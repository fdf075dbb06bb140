"""N-gram Jaccard join: documents whose word n-gram sets are nearly equal, and their components.

Every document's n-grams are ordered by how many documents hold them, rarest first. Two sets with a
Jaccard similarity of at least t share an n-gram among the first ``n - ceil(t * n) + 1`` of each, so
only these are joined. An n-gram that one document alone holds can join nothing and is left out.
Candidates then pass a length filter, a positional filter and a suffix filter and are verified once on
the whole sets. The suffix filter bounds the number of n-grams that only one of two sets holds from
below, by cells of a hash: each cell whose sizes differ in parity, and the differences of the cells'
sizes, are n-grams that the other set lacks.

Components do not need all links of a dense group. A few passes verify, for every prefix n-gram, its
documents against one of them, another one in each pass; the last pass joins the documents that these
left in different components. A pair that one pass has looked at is left out of the later ones, so each is
verified once. No link between components is lost, and a group of near copies that are
linked with each other costs pairs in proportion to its size, not to the square of it.

Defined results: a null text is empty; an empty set links with nothing and is its own component; rows
with equal sets are one class; a document without an id keeps its set size and has no component; rows
that share an id count as one document for linking, and each row is returned. Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakepipe.llm import graph, store
from lakepipe.llm.words import buffer_of, mix, shingles, words_of
from lakepipe.session import written_once

RANGES, PARITY_WORDS = 32, 8  # of the suffix filter: hash cells that are counted; 64-bit words of parities
HUB_PASSES = 2


def _sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' distinct n-grams, sorted within each text, and where each text begins."""
    grams, owner = shingles(words_of(*buffer_of(texts)), width)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    parts = [np.unique(grams[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.concatenate([*parts, np.zeros(0, np.uint64)]), starts


def _document_counts(docs: DataFrame, width: int, folder: str, bits: int) -> None:
    """For every n-gram of two or more documents, their number, as sorted arrays in ``folder``.

    Within a shard 32 bits of a hash tell n-grams apart. Two that fall together only look more
    frequent than they are, which changes the order but no result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in store.chunks(batches, "text", 2_000_000):
            keys = np.sort(_sets(texts, width)[0])
            shards, edges = store.shard_edges(keys, bits)
            rows = []
            for k, shard in enumerate(shards):
                inside = (keys[edges[k] : edges[k + 1]] << np.uint64(bits)) >> np.uint64(32)
                inside, n = np.unique(inside.astype(np.uint32), return_counts=True)
                rows.append((int(shard), len(inside), store.pack_sorted(inside), store.pack(n.astype(np.uint32))))
            yield _batch(rows, ("shard", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()))

    def merge(table: pa.Table) -> pa.Table:
        shard, keys, counts = None, [], []
        for row in table.to_pylist():
            shard = row["shard"]
            keys.append(store.unpack_sorted(row["keys"], row["n"], np.uint32))
            counts.append(store.unpack(row["counts"], row["n"], np.uint32))
        key, count, _ = store.summed(np.concatenate(keys), np.concatenate(counts))
        shared = count > 1
        whole = (np.uint64(shard) << np.uint64(64 - bits)) | (key[shared].astype(np.uint64) << np.uint64(32 - bits))
        store.save(folder, shard, key=whole, count=np.minimum(count[shared], 2**32 - 1).astype(np.uint32))
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(key)], pa.int64())})

    partial = docs.select("text").mapInArrow(count, "shard int, n long, keys binary, counts binary")
    store.seal(folder, partial.groupBy("shard").applyInArrow(merge, "shard int, n long").agg(F.count("n")).first()[0])


def _batch(rows: list[tuple], *fields: tuple[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


SIGNED = "doc_id {id}, n int, d1 long, d2 long, ranges array<int>, parity array<long>, tokens array<long>, places array<int>, grams array<long>"


def _signatures(docs: DataFrame, width: int, percent: int, folder: str, bits: int) -> DataFrame:
    """One row per document: set size, digest, sizes of the hash ranges; prefix and whole set if it can have a partner."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = store.Shards(folder, bits, sealed=True)
        low = np.uint64(32 - bits)
        for batch, texts in store.chunks(batches, "text", 1_000_000):
            grams, starts = _sets(texts, width)
            known, back = np.unique((grams >> low) << low, return_inverse=True)
            frequency = np.maximum(counts.find(known, "count")[0], 1)[back].astype(np.int64)
            none = np.zeros(1, np.uint64)  # sums wrap around; a signed zero would turn them into floats
            d1 = np.concatenate([none, np.cumsum(mix(grams))])
            d2 = np.concatenate([none, np.cumsum(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)))])
            size = np.diff(starts)
            cell = np.repeat(np.arange(len(size)), size) * RANGES + (mix(grams) >> np.uint64(59)).astype(np.int64)
            ranges = np.bincount(cell, minlength=len(size) * RANGES).astype(np.int32)
            bits_of = 64 * PARITY_WORDS
            cell = np.repeat(np.arange(len(size)), size) * bits_of + (mix(grams) % np.uint64(bits_of)).astype(np.int64)
            odd = (np.bincount(cell, minlength=len(size) * bits_of) & 1).astype(np.uint8)
            parity = np.packbits(odd).view(np.int64).reshape(-1, PARITY_WORDS)
            tokens, places, held = [], [], []
            for i, n in enumerate(size):
                own, often = grams[starts[i] : starts[i + 1]], frequency[starts[i] : starts[i + 1]]
                prefix = int(n) - (percent * int(n) + 99) // 100 + 1 if n else 0
                if n and np.count_nonzero(often == 1) < prefix:
                    first = np.argsort(often, kind="stable")[:prefix]
                    shared = np.flatnonzero(often[first] > 1)
                    tokens.append(own[first[shared]].view(np.int64))
                    places.append(shared.astype(np.int32))
                    held.append(own.view(np.int64))
                else:
                    tokens.append(np.zeros(0, np.int64))
                    places.append(np.zeros(0, np.int32))
                    held.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(size, pa.int32()),
                    pa.array((d1[starts[1:]] - d1[starts[:-1]]).view(np.int64)),
                    pa.array((d2[starts[1:]] - d2[starts[:-1]]).view(np.int64)),
                    _lists([ranges[i * RANGES : (i + 1) * RANGES] for i in range(len(size))], np.int32),
                    _lists(list(parity), np.int64),
                    _lists(tokens, np.int64),
                    _lists(places, np.int32),
                    _lists(held, np.int64),
                ],
                names=["doc_id", "n", "d1", "d2", "ranges", "parity", "tokens", "places", "grams"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(sign, SIGNED.format(id=kind))


def _lists(arrays: list[np.ndarray], dtype) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, dtype)]).astype(dtype)))


def _overlap(a: Column, b: Column, percent: int) -> Column:
    """The intersection two sets of these sizes need."""
    return F.ceil((a + b) * F.lit(percent) / F.lit(100 + percent))


def _length_filter(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs`` (a, b): suffix filter on the hash ranges, then the whole sets."""

    def side(name, *columns):
        return nodes.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    apart = F.aggregate(
        F.zip_with("a_ranges", "b_ranges", lambda x, y: F.abs(x - y)), F.lit(0), lambda total, d: total + d
    )
    a_n, b_n = F.col("a_n").cast("long"), F.col("b_n").cast("long")
    likely = written_once(
        pairs.join(side("a", "n", "ranges"), "a")
        .join(side("b", "n", "ranges"), "b")
        .where(_length_filter(a_n, b_n, percent) & (apart <= a_n + b_n - 2 * _overlap(a_n, b_n, percent)))
        .select("a", "b")
        .distinct(),
        "likely",
    )
    common = F.size(F.array_intersect("a_grams", "b_grams"))
    return (
        likely.join(side("a", "n", "grams"), "a")
        .join(side("b", "n", "grams"), "b")
        .where(common * 100 >= (F.col("a_n") + F.col("b_n") - common) * percent)
        .select("a", "b")
        .distinct()
    )


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text).

    ``width`` words make an n-gram (a shorter text is one n-gram of all its words); two documents
    link when 100 * intersection >= ``percent`` * union.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    bits = store.shard_bits(docs)
    folder = store.shared_folder(spark, "ngram-counts")
    _document_counts(docs, width, folder, bits)
    signed = written_once(_signatures(docs, width, percent, folder, bits), "signed")

    digest = ["n", "d1", "d2"]
    classes = written_once(
        signed.where("n > 0 AND doc_id IS NOT NULL").groupBy(*digest).agg(F.min("doc_id").alias("node")), "classes"
    )
    nodes = (
        signed.where("size(tokens) > 0")
        .join(classes, [*digest])
        .where("doc_id = node")
        .dropDuplicates(["node", *digest])
        .select("node", "n", "ranges", "parity", "tokens", "places", "grams")
    )
    nodes = written_once(nodes, "nodes")
    postings = nodes.select("node", F.col("n").cast("long").alias("size"), F.arrays_zip("tokens", "places").alias("z"))
    postings = postings.select("node", "size", F.explode("z").alias("z"))
    postings = postings.select(
        F.col("z.tokens").alias("bucket"), "node", "size", F.col("z.places").cast("long").alias("place")
    )
    shared = postings.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("bucket")
    postings = written_once(postings.join(shared, "bucket"), "postings")

    def may_link(x, y):
        a_size, b_size = F.col(f"{x}.size"), F.col(f"{y}.size")
        a_place, b_place = F.col(f"{x}.place"), F.col(f"{y}.place")
        rest = F.least(a_size - a_place, b_size - b_place)
        return _length_filter(a_size, b_size, percent) & (
            F.least(a_place, b_place) + rest >= _overlap(a_size, b_size, percent)
        )

    links = block = tried = None

    def verified_once(pairs):
        """The links among the pairs that no earlier pass has looked at."""
        nonlocal tried
        new = pairs.distinct() if tried is None else pairs.distinct().join(tried, ["a", "b"], "left_anti")
        new = written_once(new, "pairs")
        tried = new if tried is None else tried.union(new)
        return written_once(_verified(new, nodes, percent), "links")

    for turn in range(HUB_PASSES):
        # Each n-gram's documents against one of them, another one for another n-gram and pass.
        members = postings.withColumn("block", F.col("node"))
        if block is not None:
            members = postings.join(block, "node", "left").withColumn("block", F.coalesce("component", "node"))
        hubs = members.groupBy("bucket").agg(
            F.min_by(F.struct("node", "size", "place", "block"), F.xxhash64("bucket", "node", F.lit(turn))).alias("hub")
        )
        # Written, so that the join has exchanges of its own, whose hot partitions Spark can split.
        hubs = written_once(hubs.select("bucket", "hub.*"), "hubs").alias("hub")
        met = members.alias("own").join(hubs, "bucket")
        met = met.where((F.col("own.block") != F.col("hub.block")) & may_link("own", "hub"))
        a, b = F.col("own.node"), F.col("hub.node")
        found = verified_once(met.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")))
        links = found if links is None else links.union(found)
        block = written_once(graph.components(links), "blocks")

    # What still shares a prefix n-gram and is not in one component yet.
    members = postings.join(block, "node", "left").withColumn("block", F.coalesce("component", "node"))
    members = members.drop("component").join(nodes.select("node", "parity"), "node")

    def near(x, y):
        odd = sum(
            F.bit_count(F.col(f"{x}.parity")[k].bitwiseXOR(F.col(f"{y}.parity")[k])) for k in range(PARITY_WORDS)
        )
        sizes = F.col(f"{x}.size"), F.col(f"{y}.size")
        return may_link(x, y) & (odd <= sizes[0] + sizes[1] - 2 * _overlap(*sizes, percent))

    links = links.union(verified_once(graph.across_blocks(members, near)))
    component = graph.components(links)
    named = classes.join(component, "node", "left").select(*digest, F.coalesce("component", "node").alias("component"))
    return signed.select("doc_id", *digest).join(named, digest, "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def one_per_component(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs`` without those whose component holds a document with a smaller id.

    Rows without an id are kept. Of rows that share an id, all are kept or none.
    """
    found = jaccard_components(docs, width, percent)
    extra = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(extra, "doc_id", "left_anti")
