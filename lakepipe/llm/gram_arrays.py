"""Sorted hash arrays of n-grams with counts, one file per level and shard, memory-mapped by tasks.

A shard's grams lie in four runs, each sorted: those whose counts are all as of a gram seen once, which
need no counts, and those whose largest count fits one, four or eight bytes. The shard's number is the
first bits of the 64-bit key; a run holds the next 40 bits (32 and 8). A gram that was never counted is
taken for another one with a chance of the shard's grams times 2^-40.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lakepipe.llm import store
from lakepipe.llm.words import mix

WIDTHS = (None, np.uint8, np.uint32, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def keys_of(columns: list[np.ndarray]) -> np.ndarray:
    """The 64-bit key of each gram; ``columns`` holds its words' numbers, oldest first."""
    key = mix(columns[0].astype(np.uint64) + _STEP)
    for column in columns[1:]:
        key = mix(key * _STEP + column.astype(np.uint64))
    return key


def summed(columns: list[np.ndarray], values: list[np.ndarray]):
    """Sorted distinct keys with their grams and the sums of their values."""
    keys = keys_of(columns)
    if not len(keys):
        return keys, columns, [v.astype(np.int64) for v in values]
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums = [np.add.reduceat(v[order].astype(np.int64), first) for v in values]
    return keys[first], [c[order[first]] for c in columns], sums


def _pack(array: np.ndarray) -> bytes:
    top = int(array.max(initial=0))
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max)
    return bytes([np.dtype(kind).itemsize]) + store.pack(array.astype(kind))


def _unpack(data: bytes, count: int) -> np.ndarray:
    return store.unpack(data[1:], count, np.dtype(f"u{data[0]}"))


def schema(totals: int) -> pa.Schema:
    fields = [("shard", pa.int32()), ("n", pa.int64()), ("columns", pa.list_(pa.binary())), ("values", pa.list_(pa.binary()))]
    return pa.schema([*fields, ("totals", pa.list_(pa.int64()))][: 4 + (totals > 0)])


def packed(columns: list[np.ndarray], values: list[np.ndarray], bits: int) -> list[dict]:
    """One row per shard with its distinct grams, in the order of their first words, whose repeats take hardly any space."""
    keys, columns, values = summed(columns, values)
    shards, edges = store.shard_edges(keys, bits)
    rows = []
    for shard, lo, hi in zip(shards, edges[:-1], edges[1:], strict=True):
        held = [c[lo:hi] for c in columns]
        order = np.lexsort(held[1::-1])
        leading = np.diff(held[0][order], prepend=np.uint64(0))
        rows.append(
            {
                "shard": int(shard),
                "n": int(hi - lo),
                "columns": [_pack(leading), *[_pack(c[order]) for c in held[1:]]],
                "values": [_pack(v[lo:hi][order]) for v in values],
            }
        )
    return rows


def unpacked(rows: list[dict], n_columns: int, n_values: int):
    """The grams and values of several packed rows, one after the other."""
    columns = [[np.zeros(0, np.uint64)] for _ in range(n_columns)]
    values = [[np.zeros(0, np.int64)] for _ in range(n_values)]
    for row in rows:
        if row["n"]:
            for k, data in enumerate(row["columns"]):
                column = _unpack(data, row["n"]).astype(np.uint64)
                columns[k].append(np.cumsum(column, dtype=np.uint64) if k == 0 else column)
            for held, data in zip(values, row["values"], strict=True):
                held.append(_unpack(data, row["n"]).astype(np.int64))
    return [np.concatenate(c) for c in columns], [np.concatenate(v) for v in values]


def _cut(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    rest = keys << np.uint64(bits)
    return (rest >> np.uint64(32)).astype(np.uint32), (rest >> np.uint64(24)).astype(np.uint8)


def save(folder: str, level: int, shard: int, bits: int, keys: np.ndarray, values: list[np.ndarray], once: tuple) -> None:
    """Writes a shard's sorted grams; ``once`` holds the values that need not be written."""
    top = np.max(values, axis=0)
    plain = np.all([v == o for v, o in zip(values, once, strict=True)], axis=0)
    kind = np.where(plain, 0, 1 + (top > 255) + (top >= 2**32))
    sections = [np.bincount(kind, minlength=4).astype(np.int64)]
    for k, width in enumerate(WIDTHS):
        of = kind == k
        sections += _cut(keys[of], bits)
        sections += [v[of].astype(width) for v in values] if width else []
    raw = [s.tobytes() for s in sections]
    whole = b"".join(r + b"\0" * (-len(r) % 8) for r in raw)
    store.save(folder, shard, **{f"grams{level}": np.frombuffer(whole, np.uint8)})


class Grams:
    """Look-ups in the sealed arrays of one level."""

    def __init__(self, folder: str, level: int, bits: int, once: tuple):
        self.bits, self.once, self.name = bits, once, f"grams{level}"
        self._shards, self._runs = store.Shards(folder, bits, self.name, sealed=True), {}

    def _of(self, shard: int) -> list:
        if shard not in self._runs:
            raw, runs, at = self._shards._array(self.name, shard), [], 32

            def section(kind, count):
                nonlocal at
                size = count * np.dtype(kind).itemsize
                begin, at = at, at + size + (-size % 8)
                return raw[begin : begin + size].view(kind)

            for count, width in zip(raw[:32].view(np.int64).tolist() if raw is not None else (), WIDTHS):
                hi, lo = section(np.uint32, count), section(np.uint8, count)
                values = [section(width, count) for _ in self.once] if width else self.once
                if count:
                    runs.append((hi, lo, values))
            self._runs[shard] = runs
        return self._runs[shard]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of sorted distinct ``keys``, a row per value; 0 where a key is absent."""
        out = np.zeros((len(self.once), len(keys)))
        shards, edges = store.shard_edges(keys, self.bits)
        for shard, begin, end in zip(shards, edges[:-1], edges[1:], strict=True):
            hi, lo = _cut(keys[begin:end], self.bits)
            rest = np.arange(len(hi))
            for stored_hi, stored_lo, values in self._of(int(shard)):
                at, left, absent = np.searchsorted(stored_hi, hi[rest]), np.arange(len(rest)), np.ones(len(rest), bool)
                while len(left):
                    left = left[at[left] < len(stored_hi)]
                    left = left[stored_hi[at[left]] == hi[rest[left]]]
                    same = stored_lo[at[left]] == lo[rest[left]]
                    hit, left = left[same], left[~same]
                    for row, value in zip(out, values, strict=True):
                        row[begin + rest[hit]] = value if np.isscalar(value) else value[at[hit]]
                    absent[hit] = False
                    at[left] += 1
                rest = rest[absent]
        return out
