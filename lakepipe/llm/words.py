"""Words of whole batches of texts as 64-bit hashes, computed with numpy over the UTF-8 bytes.

A word is a maximal run of characters other than space and the control characters 9 to 13; all of
these are single bytes in UTF-8, so bytes can be scanned without decoding. No loop runs per word.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0x5851F42D4C957F2D | 1


class Words(NamedTuple):
    """``hashes[k]`` is word ``k`` of the batch; text ``i`` has the words ``starts[i]:starts[i + 1]``."""

    hashes: np.ndarray
    starts: np.ndarray
    first: np.ndarray  # byte offset of each word in the batch's buffer
    length: np.ndarray  # in bytes


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_table(lower: bool) -> np.ndarray:
    table = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLDEN)
    if lower:
        table[65:91] = table[97:123]
    return table


_TABLES = {True: _byte_table(True), False: _byte_table(False)}
_BREAKS = np.zeros(256, bool)
_BREAKS[[9, 10, 11, 12, 13, 32]] = True


def buffer_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after another, each followed by a space, and where each begins."""
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    return data, np.concatenate([[0], ends]).astype(np.int64)


def words_of(data: np.ndarray, begins: np.ndarray, lower: bool = True, breaks: np.ndarray = _BREAKS) -> Words:
    """The words of a buffer made by ``buffer_of``; ``lower`` folds A-Z.

    ``breaks`` says of each byte whether it separates words; a space must, bytes from 128 on must not.
    """
    gap = breaks[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(data) and not gap[0]:
        edge = np.concatenate([[0], edge])
    first, last = edge[0::2], edge[1::2]  # the buffer ends with a space, so edges come in pairs
    length = last - first
    hashes = np.empty(len(first), np.uint64)
    block = 1 << 19  # words; bounds the work arrays
    longest = int(length.max(initial=1))
    power = np.multiply.accumulate(np.full(longest, _STEP, np.uint64))
    table = _TABLES[lower]
    for at in range(0, len(first), block):
        f, n = first[at : at + block], length[at : at + block]
        lo, hi = int(f[0]), int(f[-1] + n[-1])
        inside = np.flatnonzero(~gap[lo:hi])
        offsets = np.concatenate([[0], np.cumsum(n)[:-1]])
        place = np.arange(len(inside)) - np.repeat(offsets, n)
        hashes[at : at + block] = np.add.reduceat(table[data[lo:hi][inside]] * power[place], offsets)
    starts = np.searchsorted(first, begins)
    return Words(mix(hashes ^ (length.astype(np.uint64) * _GOLDEN)), starts, first, length)


def utf8(texts) -> list[bytes]:
    """Texts of an Arrow column as bytes; null counts as empty."""
    return [b"" if t is None else t for t in texts]


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's word windows as hashes, with the text of each; shorter texts give one window of all their words."""
    h, starts = words.hashes, words.starts
    counts = np.diff(starts)
    doc = np.repeat(np.arange(len(counts)), counts)
    combined = np.zeros(len(h), np.uint64)
    size = np.minimum(counts, width)[doc]
    room = starts[1:][doc] - np.arange(len(h))
    keep = room >= size
    keep &= (counts[doc] >= width) | (np.arange(len(h)) == starts[:-1][doc])
    at = np.flatnonzero(keep)
    span = size[at]
    combined = np.full(len(at), _GOLDEN, np.uint64)
    for k in range(width):
        here = span > k
        combined[here] = mix(combined[here] * np.uint64(_STEP) + h[at[here] + k])
    return mix(combined + span.astype(np.uint64)), doc[at]
