"""Sorted key arrays in the shared folder: counted by Spark tasks, memory-mapped by Spark tasks.

Keys are uniform 64-bit hashes. A shard holds the keys with the same leading bits, sorted, so the
shards in their order are one sorted array. Each map task sends its distinct keys only, one packed
row per shard; each merge task writes the arrays of one shard. Nothing passes through the driver.
"""

from __future__ import annotations

import ctypes
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakepipe.session import scratch_dir


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder of the shared file system as a plain path, for arrays that tasks map into memory."""
    uri = scratch_dir(spark, purpose)
    scheme, _, rest = uri.rpartition(":")
    if scheme not in ("", "file"):
        raise ValueError(f"arrays are memory-mapped: spark.checkpoint.dir must be a mounted folder, not {scheme}:")
    path = "/" + rest.lstrip("/")
    os.makedirs(path, exist_ok=True)
    return path


def shard_bits(frame: DataFrame) -> int:
    """Bits that number the shards: twice as many shards as input partitions, 32 at least."""
    last = frame.select(F.spark_partition_id().alias("part")).agg(F.max("part")).first()[0]
    return max(5, int(2 * ((last or 0) + 1) - 1).bit_length())


def pack(array: np.ndarray) -> bytes:
    """Byte planes, compressed: small and slowly growing numbers take little more than their own bits."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), -1).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, count: int, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = pa.decompress(data, decompressed_size=count * width, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, count)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_sorted(data: bytes, count: int, dtype=np.uint64) -> np.ndarray:
    return np.cumsum(unpack(data, count, dtype), dtype=dtype)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the sum of their counts, and a row where each was found."""
    if not len(keys):
        return keys, counts.astype(np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first), order[first]


def shard_edges(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards present in sorted ``keys``, and where each begins; the end is appended."""
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return shard[first], np.append(first, len(keys))


def save(folder: str, shard: int, **arrays: np.ndarray) -> None:
    """Each array as one file; a repeated task replaces the file by an equal one."""
    for name, array in arrays.items():
        unfinished = f"{folder}/.{name}-{shard}-{uuid.uuid4().hex}"
        with open(unfinished, "wb") as out:
            np.save(out, array)
        os.replace(unfinished, f"{folder}/{name}-{shard}.npy")


def _listed(folder: str, key: str) -> list[int]:
    found = [re.fullmatch(rf"{re.escape(key)}-([0-9]+)\.npy", name) for name in os.listdir(folder)]
    return sorted(int(m[1]) for m in found if m)


def seal(folder: str, written: int, key: str = "key") -> None:
    """Records which shards there are, once all tasks have written theirs; ``written`` is how many these report."""
    shards = _listed(folder, key)
    if len(shards) != written:
        raise FileNotFoundError(f"{folder} has {len(shards)} of {written} shards: not all executors write to it")
    with open(f"{folder}/{key}.shards", "wb") as out:
        np.save(out, np.array(shards, np.int64))


class Shards:
    """Look-ups in a folder's arrays. Files are mapped when first needed; one that nothing was written for is empty.

    In a ``sealed`` folder a shard that was written and cannot be seen here is an error, and so is a missing record. Tasks
    look up in sealed folders only; for arrays that one process has saved by itself the files there count.
    """

    def __init__(self, folder: str, bits: int, key: str = "key", sealed: bool = False):
        self.folder, self.bits, self.key, self._maps = folder, bits, key, {}
        self._written = set(np.load(f"{folder}/{key}.shards").tolist() if sealed else _listed(folder, key))

    def _array(self, name: str, shard: int):
        if (name, shard) not in self._maps:
            array = np.load(f"{self.folder}/{name}-{shard}.npy", mmap_mode="r") if shard in self._written else None
            self._maps[name, shard] = array if array is not None and len(array) else None
        return self._maps[name, shard]

    def find(self, keys: np.ndarray, *names: str | tuple[str, type, int]) -> list[np.ndarray]:
        """The named values of sorted distinct ``keys``: float64 and 0 where absent, or a name with its type and value."""
        wished = [(name, np.float64, 0) if isinstance(name, str) else name for name in names]
        names = [name for name, _, _ in wished]
        out = [np.full(len(keys), absent, dtype) for _, dtype, absent in wished]
        shards, edges = shard_edges(keys, self.bits)
        for k, shard in enumerate(shards):
            stored = self._array(self.key, int(shard))
            if stored is None:
                continue
            wanted = keys[edges[k] : edges[k + 1]]
            at = np.minimum(np.searchsorted(stored, wanted), len(stored) - 1)
            hit = np.flatnonzero(stored[at] == wanted)
            for values, name in zip(out, names, strict=True):
                values[edges[k] + hit] = self._array(name, int(shard))[at[hit]]
        return out


def give_back() -> None:
    """Return memory that this worker process no longer uses to the system; idle workers stay alive."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # a C library without that call


def chunks(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4_000_000):
    """(record batch, its texts as bytes) with at most ``most_bytes`` of text, or one text if that is longer."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary()).to_pylist()
        texts = [b"" if t is None else t for t in texts]
        begin, held = 0, 0
        for i, text in enumerate(texts):
            if held and held + len(text) > most_bytes:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, held = i, 0
            held += len(text)
        if texts:
            yield batch.slice(begin), texts[begin:]
        del batch, texts
        give_back()
