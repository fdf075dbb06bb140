"""Packing in the order of a space-filling curve.

A document's tokens are hashed to signs along a few dimensions and summed, which places documents with
similar words near each other. The point's Hilbert key orders the documents; they are range-sorted by it
and laid end to end, and the tape is cut every ``length`` tokens. Neighbours on the curve so share
sequences, and only the very last sequence is not full.

The tape's positions come from sums per range (one row per range meets in one task), never from a pass
over all rows in one place. Equal documents have equal keys; ids and row numbers order them, so a group
of copies of any size is spread over ranges.

Defined results: a null text is empty and has the closing id only; rows that share an id, or have none,
are packed each by itself; texts of any length are encoded whole. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from lakepipe.llm import store
from lakepipe.llm.bpe import byte_names, newer_than_python, one_thread
from lakepipe.llm.words import mix
from lakepipe.session import written_once

DIMENSIONS, BITS = 4, 15

#: Fixed value: how byte-level tokenizers of this family split text before merging.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_SPACE = 20_000  # characters of white space that the quicker encoder's pattern still takes
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")


class ByteBpe:
    """The ids of a byte-level tokenizer file.

    The tokenizers library reads the file. Texts go to it that hold the string of a special token, characters
    newer than this Python (the two libraries' tables may differ there) or a run of white space so long that
    the quicker encoder's pattern fails on it. All others go to that encoder over the same vocabulary, which
    gives the same ids as long as the file's merges are in the order of their ids.
    """

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._special = tuple(t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values())
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, merges = model["vocab"], model["merges"]
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
        if made != sorted(made):
            raise ValueError("the merges are not in the order of their ids")
        byte_of = {name: b for b, name in enumerate(byte_names())}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if all(c in byte_of for c in token)}
        self._quick = tiktoken.Encoding("texts", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: bytes) -> np.ndarray:
        plain = text.decode()
        spaces = len(plain) >= LONG_SPACE and _LONG_SPACE.search(plain)
        if spaces or any(s in text for s in self._special) or newer_than_python(plain):
            return np.array(self._tokenizer.encode(plain, add_special_tokens=False).ids, "<u4")
        return self._quick.encode_to_numpy(plain, disallowed_special=()).astype("<u4", copy=False)


@lru_cache(maxsize=1)
def loaded(path: str) -> ByteBpe:
    """The encoder of this worker process: its tasks share what it has learnt."""
    one_thread()
    return ByteBpe(path)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert keys of integer points (rows, dimensions), each coordinate below 2 ** bits.

    Skilling's transform of axes to the transposed key, then the bits are interleaved.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: list[np.ndarray], dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """The Hilbert keys of documents given as token ids."""
    top = max((int(i.max(initial=0)) for i in ids), default=0)
    hashed = mix(np.arange(top + 1, dtype=np.uint64) + np.uint64(0x51ED2701))
    signs = (2 * ((hashed[:, None] >> np.arange(dimensions, dtype=np.uint64)) & np.uint64(1)).astype(np.int8)) - 1
    sums = np.array([signs[i].sum(0, dtype=np.int64) / np.sqrt(max(1, len(i))) for i in ids]).reshape(-1, dimensions)
    # A squashing that spreads roughly normal sums over the whole range.
    points = (0.5 + 0.5 * np.tanh(0.8 * sums)) * (2**bits - 1)
    return hilbert(points.astype(np.int64), bits)


def pack(docs: DataFrame, tokenizer: str, length: int = 1024, closing_id: int = 0) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): which tokens of which document lie where.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids``, the piece's
    tokens as little-endian unsigned 32-bit integers.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    closing = np.uint32(closing_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(tokenizer)
        for batch, texts in store.chunks(batches, "text", 1_000_000):
            ids = [np.append(bpe.encode(text), closing) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(curve_keys([i[:-1] for i in ids])),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([store.pack(i) for i in ids], pa.binary()),
                ],
                names=["doc_id", "curve", "doc_tokens", "packed"],
            )

    encoded = docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, curve long, doc_tokens long, packed binary")
    encoded = written_once(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded")

    order = ["curve", "doc_id", "row"]
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = encoded.select("curve", "doc_id", "row", "doc_tokens").repartitionByRange(ranges, *order)
    ranged = written_once(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sums = sums.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("before", F.coalesce(F.sum("doc_tokens").over(within), F.lit(0)))
    placed = placed.join(F.broadcast(sums), "part").select("row", (F.col("base") + F.col("before")).alias("begin"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        for batch in batches:
            for row_at in range(0, batch.num_rows, 256):
                part = batch.slice(row_at, 256)
                rows = []
                for doc, begin, tokens, packed in zip(*(part.column(c).to_pylist() for c in columns), strict=True):
                    ids = memoryview(store.unpack(packed, tokens, "<u4").tobytes())
                    at = 0
                    while at < tokens:
                        sequence, offset = divmod(begin + at, length)
                        size = min(length - offset, tokens - at)
                        piece = ids[4 * at : 4 * (at + size)]
                        rows.append((doc, at, size, zlib.crc32(piece), tokens, sequence, offset, piece.tobytes()))
                        at += size
                fields = [("doc_id", part.schema.field("doc_id").type), *((c, pa.int64()) for c in numbers)]
                fields = pa.schema([*fields, ("ids", pa.binary())])
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    columns = ["doc_id", "begin", "doc_tokens", "packed"]
    joined = encoded.join(placed, "row").select(*columns)
    return joined.mapInArrow(
        cut,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
