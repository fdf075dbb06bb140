"""Token counts by rank-synchronous merging of ragged arrays.

A text is split into pre-tokens as a byte-level tokenizer splits it. The distinct ones of a batch are held
as one flat array of symbols with the start of each sequence. In every round each sequence merges its pair
of lowest rank, at all its places at once, and leaves the batch when no pair of it has a rank; the symbols
that survive are its tokens. A pair whose merge was learnt later can never come before an earlier one, so
this equals merging pair by pair.

A sequence of many bytes would keep its own round for every rank it holds, each over all its symbols. Such
sequences keep the places of each rank instead, so a round costs what it merges.

Defined results: a null or empty text has no tokens; the string of a special token in a text is one token,
as the library has it by default; rows that share an id, or have none, are counted each by itself; texts of
any length are counted whole. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from lakepipe.llm import store
from lakepipe.llm.bpe import byte_names, newer_than_python

MOST_KNOWN = 400_000  # pre-tokens a worker remembers before it starts afresh, some 150 bytes each
LONG = 400  # symbols from which a sequence keeps its places by rank
_NONE = np.int32(2**31 - 1)

#: How byte-level tokenizers of this family split text, and the same on ASCII alone.
_SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""").findall
_SPLIT_ASCII = re.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"""
).findall


class PairRanks:
    """Ranks of symbol pairs in an open hash table of arrays; looks up whole arrays of pairs."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int32)
        self.merged = merged.astype(np.int32)
        waiting, slot = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[waiting[free]]
            placed = self.keys[slot] == keys[waiting]
            self.ranks[slot[placed]] = waiting[placed]
            waiting, slot = waiting[~placed], (slot[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; the highest number where it has none."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(keys)
        stored = self.keys[slot]
        out = np.where(stored == keys, self.ranks[slot], _NONE)
        open_ = np.flatnonzero((stored != keys) & (stored != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            stored = self.keys[slot[open_]]
            hit = stored == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (stored != -1)]
        return out

    def survivors(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """How many symbols each sequence keeps; ``starts`` has the end appended, no sequence is empty."""
        left = np.diff(starts)
        for i in np.flatnonzero(left >= LONG):
            left[i] = self._survivors_of_long(symbols[starts[i] : starts[i + 1]])
        short = np.diff(starts) < LONG
        owner = np.repeat(np.arange(len(left)), np.diff(starts))
        inside = short[owner]
        symbols, owner = symbols[inside].astype(np.int32), owner[inside]
        last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
        ranks = np.full(len(symbols), _NONE, np.int32)
        pair = np.flatnonzero(~last)
        ranks[pair] = self.find(symbols[pair], symbols[pair + 1])
        while len(symbols):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(first, len(owner)))
            least = np.minimum.reduceat(ranks, first)
            going = np.repeat(least < _NONE, size)
            if not going.all():  # sequences without a pair of a rank are done
                symbols, owner, ranks = symbols[going], owner[going], ranks[going]
                size, least = size[least < _NONE], least[least < _NONE]
                if not len(symbols):
                    break
            places = np.flatnonzero(ranks == np.repeat(least, size))
            places = _every_other(places, places[1:] == places[:-1] + 1)
            np.subtract.at(left, owner[places], 1)
            symbols[places] = self.merged[ranks[places]]
            stays = np.ones(len(symbols), bool)
            stays[places + 1] = False
            at = (np.cumsum(stays) - 1)[places]
            symbols, owner = symbols[stays], owner[stays]
            ranks = ranks[stays]
            # Of a merged pair the new symbol's pair and the one before it are new.
            new = np.zeros(len(symbols), bool)
            new[at] = True
            new[at[at > 0] - 1] = True
            ranks[new] = _NONE
            new[-1] = False
            new[:-1] &= owner[1:] == owner[:-1]
            changed = np.flatnonzero(new)
            ranks[changed] = self.find(symbols[changed], symbols[changed + 1])
        return left

    def _survivors_of_long(self, symbols: np.ndarray) -> int:
        """The same rounds for one sequence, by linked places and the places of each rank."""
        n = len(symbols)
        symbols = symbols.astype(np.int32)
        after, before = np.arange(1, n + 1), np.arange(-1, n)
        ranks = np.append(self.find(symbols[:-1], symbols[1:]), _NONE)
        held: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []
        left = n

        def enter(places: np.ndarray) -> None:
            places = places[ranks[places] < _NONE]
            if not len(places):
                return
            places = places[np.argsort(ranks[places], kind="stable")]
            found, begin = np.unique(ranks[places], return_index=True)
            for rank, part in zip(found.tolist(), np.split(places, begin[1:]), strict=True):
                if rank not in held:
                    held[rank] = []
                    heapq.heappush(waiting, rank)
                held[rank].append(part)

        if n > 1:
            enter(np.arange(n))
        while waiting:
            rank = heapq.heappop(waiting)
            parts = held.pop(rank)
            places = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            places = places[ranks[places] == rank]
            places = _every_other(places, after[places[:-1]] == places[1:])
            if not len(places):
                continue
            gone = after[places]
            left -= len(places)
            symbols[places] = self.merged[rank]
            ranks[gone] = _NONE
            after[places] = after[gone]
            before[after[gone]] = places
            earlier = before[places]
            changed = np.union1d(places, earlier[earlier >= 0])
            ranks[changed] = _NONE
            changed = changed[after[changed] < n]
            ranks[changed] = self.find(symbols[changed], symbols[after[changed]])
            enter(changed)
        return left


def _every_other(places: np.ndarray, overlaps: np.ndarray) -> np.ndarray:
    """``places`` without those whose pair begins inside one taken before; ``overlaps[i]``: i and i + 1 share a symbol."""
    if not overlaps.any():
        return places
    fresh = np.append(True, ~overlaps)
    run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    return places[(np.arange(len(places)) - run) % 2 == 0]


class TokenCounter:
    """Counts the tokens a byte-level BPE tokenizer file gives."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splits = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        odd += [k for k in ("byte_fallback", "ignore_merges") if model.get(k)]
        odd += [t["content"] for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
        if odd or spec["normalizer"] or splits.get("type") != "ByteLevel" or splits.get("add_prefix_space") or not splits.get("use_regex", True):
            raise ValueError(f"not a plain byte-level BPE file: {odd or splits}")
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, merged = (np.array([f(p) for p in pairs], np.int64).reshape(-1) for f in (
            lambda p: vocab[p[0]], lambda p: vocab[p[1]], lambda p: vocab[p[0] + p[1]]))
        learnt = np.full(max(vocab.values()) + 1, -1)
        learnt[merged] = np.arange(len(merged))
        if (np.maximum(learnt[left], learnt[right]) >= np.arange(len(merged))).any():
            raise ValueError("a merge uses a symbol that is learnt later")
        self._ranks = PairRanks(left, right, merged)
        self._symbol = np.array([vocab[c] for c in byte_names()], np.int32)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._library = Tokenizer.from_file(path).pre_tokenizer
        self._known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii():
            return _SPLIT_ASCII(text)
        if newer_than_python(text):  # the tables of two libraries may differ there
            return [text[begin:end] for _, (begin, end) in self._library.pre_tokenize_str(text)]
        return _SPLIT(text)

    def _learn(self, pieces: list[str]) -> None:
        spelled = [p.encode() for p in pieces]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in spelled])])
        symbols = self._symbol[np.frombuffer(b"".join(spelled), np.uint8)]
        self._known.update(zip(pieces, self._ranks.survivors(symbols, starts).tolist(), strict=True))

    def counts(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        if len(self._known) > MOST_KNOWN:
            self._known = {}
        split, extra = [], []
        for text in texts:
            parts = self._special.split(text) if self._special and self._special.search(text) else [text]
            found = [self.pre_tokens(part) for part in parts if part]
            split.append(found[0] if len(found) == 1 else [p for pieces in found for p in pieces])
            extra.append(len(parts) - 1)
        known = self._known
        new = list(set().union(*split) - known.keys())
        if new:
            self._learn(new)
        return [sum(map(known.__getitem__, found)) + more for found, more in zip(split, extra, strict=True)]


@lru_cache(maxsize=1)
def loaded(path: str) -> TokenCounter:
    """The counter of this worker process: its tasks share what it has learnt."""
    return TokenCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs`` (doc_id, text).

    ``tokenizer`` is the path of the tokenizer file on every worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(tokenizer)
        for batch, texts in store.chunks(batches, "text", 1_000_000):
            counts = np.array(counter.counts([t.decode() for t in texts]), np.int64)
            sizes = np.array([len(t) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(counts), pa.array(counts > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
