"""Line dedup by a log-template tree of fixed depth.

A line descends the tree by its number of tokens and then by its first ``DEPTH`` tokens; tokens that hold
a digit are variable fields already and all look alike. In the leaf the remaining tokens form ``FIELDS``
blocks of nearly equal length, or more where a block would pass ``FIELD_TOKENS`` tokens. A template fixes all
blocks, or all but one, which is then a variable field as well, so lines that differ within one block share
one. What a template fixes are its words: tokens with a letter and without a digit. A template with variable
fields must have ``FIXED_WORDS`` of them or more, and they must be half of the line's tokens; one without
enough text of its own never recurs. Because a line's templates depend on the line alone, the tree needs no order of arrival: tasks count
templates by key, merge tasks add the counts, and no leaf is ever gathered in one place.

Every line also is a template of its own, in which digits vary no more than other tokens do. A line of fewer
than ``min_tokens`` tokens says too little by itself: the larger a corpus, the more documents hold such a line
by chance or by custom ("Thank you.", "else:"), so no number of documents makes it recur alone. It goes only
as part of a run: ``RUN`` lines that follow each other (lines without words aside) and have ``min_tokens``
tokens together are one template, as they are.

The longer the text that documents share, the less it takes chance to explain it: a template recurs if the
documents with lines that match it, times the tokens it fixes, make ``REPEATED_TOKENS``. Two documents are
the least (from 50 fixed tokens on) and ``min_docs`` are enough for any template. None of these numbers changes
with the table. Its lines stay in the document with the smallest id that has them and are dropped from all
others. A document that had words and has none left is dropped.

Recurring templates are kept as sorted arrays in the shared folder (see ``store``), which the tasks that
clean the texts map into memory.

Defined results: a null text stays null; an empty text and lines without words stay as they are; a
document without an id never is a template's first one; rows that share an id count as one row each, and
all of them keep their lines if the id is the smallest. Other columns are kept, but for those named
``n_lines`` and ``dropped_lines``, which the result has itself. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakepipe.llm import store
from lakepipe.llm.words import Words, buffer_of, mix, words_of

DEPTH, FIELDS, VARIABLE_FROM = 2, 3, 8
MIN_DOCS, MIN_TOKENS, RUN = 10, 10, 3
REPEATED_TOKENS = 100
FIELD_TOKENS, FIXED_WORDS = 8, 2
_VARIABLE = np.uint64(0x3A3A3A3A3A3A3A3B)
_LETTERS = np.zeros(256, bool)
# A-Z, a-z, and first bytes of characters from U+00C0 on but for U+2000 to U+2FFF, which are signs, and U+10000 on.
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[0xC3:0xE2] = _LETTERS[0xE3:0xF0] = True
_NO_ID = np.iinfo(np.int64).max


def docs_needed(fixed: np.ndarray, min_docs: int) -> np.ndarray:
    """The documents that make templates of so many fixed tokens recur."""
    by_length = -(-REPEATED_TOKENS // np.maximum(1, fixed))
    return np.minimum(np.maximum(2, by_length), min_docs).astype(np.uint32)


def _holds(words: Words, wanted: np.ndarray) -> np.ndarray:
    """Whether each word has a wanted byte."""
    before = np.concatenate([np.zeros(1, np.int32), np.cumsum(wanted, dtype=np.int32)])
    return before[words.first + words.length] > before[words.first]


def _says_enough(fixed: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (fixed >= FIXED_WORDS) & (2 * fixed >= count)


def templates(texts: list[bytes], min_tokens: int = MIN_TOKENS) -> tuple[np.ndarray, ...]:
    """(template keys, the line of each, its fixed tokens, the text of each line, each line's number within its text).

    Lines are numbered through the batch; lines without enough tokens have no key.
    """
    data, begins = buffer_of(texts)
    words = words_of(data, begins)
    # Line numbers through the batch: line ends, and the separator that closes each text.
    closes = data == 10
    closes[begins[1:] - 1] = True
    ends = np.flatnonzero(closes)
    text_of = np.searchsorted(begins, ends, side="right") - 1
    number = np.arange(len(ends)) - np.searchsorted(text_of, text_of)
    line = np.searchsorted(ends, words.first)
    varies = _holds(words, (data >= 48) & (data <= 57))
    count = np.bincount(line, minlength=len(ends))
    place = np.arange(len(line)) - np.searchsorted(line, line)
    mine = count[line]
    blocks = np.maximum(FIELDS, -(-(mine - DEPTH) // FIELD_TOKENS))
    block = np.where(place < DEPTH, 0, 1 + (place - DEPTH) * blocks // np.maximum(1, mine - DEPTH))
    step = np.uint64(0x9E3779B97F4A7C15) * place.astype(np.uint64)
    # Sums of token hashes per line and block wrap around, as hashes may.
    change = np.concatenate([[True], line[1:] != line[:-1]])[: len(line)]
    starts = np.flatnonzero(change)
    runs = np.flatnonzero(change | np.concatenate([[True], block[1:] != block[:-1]])[: len(line)])
    with_tokens = line[starts]

    def per_line(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ends), values.dtype)
        out[with_tokens] = np.add.reduceat(values, starts)
        return out

    plain = mix(words.hashes + step)
    part = np.where(varies, mix(_VARIABLE + step), plain)
    says = _holds(words, _LETTERS[data])
    fixed = (says & ~varies).astype(np.int64)
    exact, whole, whole_fixed = per_line(plain), per_line(part), per_line(fixed)
    size = mix(count.astype(np.uint64))
    # The line itself; the line with its digits variable; and that but for one block.
    some = np.flatnonzero((count >= max(1, min_tokens)) & ((per_line(says.astype(np.int64)) > 0) | (count >= VARIABLE_FROM)))
    numbered = per_line(varies.astype(np.int64)) > 0
    numbered = np.flatnonzero(numbered & _says_enough(whole_fixed, count) & (count >= min_tokens))
    of, number_of, of_fixed = line[runs], block[runs], np.add.reduceat(fixed, runs)
    free = (number_of > 0) & (count[of] >= max(min_tokens, VARIABLE_FROM))
    free &= _says_enough(whole_fixed[of] - of_fixed, count[of])
    sums, run_fixed = np.add.reduceat(part, runs)[free], of_fixed[free]
    of, number_of = of[free], number_of[free].astype(np.uint64)
    run_key, run_line, run_count = _line_runs(exact + size, count, with_tokens, text_of, min_tokens)
    keys = [exact[some] + size[some], whole[numbered] + size[numbered], whole[of] - sums + size[of] + number_of, run_key]
    held = [count[some], whole_fixed[numbered], whole_fixed[of] - run_fixed, run_count]
    lines = [some, numbered, of, run_line]
    return mix(np.concatenate(keys)), np.concatenate(lines), np.concatenate(held), text_of, number


def _line_runs(
    own: np.ndarray, count: np.ndarray, with_tokens: np.ndarray, text_of: np.ndarray, min_tokens: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, line, tokens) of every run with a line too short to be a template, once for each of its lines."""
    first = np.arange(max(0, len(with_tokens) - RUN + 1))
    members = with_tokens[first[:, None] + np.arange(RUN)] if len(first) else np.zeros((0, RUN), np.int64)
    together = count[members].sum(1)
    members = members[
        (text_of[members[:, 0]] == text_of[members[:, -1]])
        & (count[members].min(1, initial=min_tokens) < min_tokens)
        & (together >= max(1, min_tokens))
    ]
    together = count[members].sum(1)
    key = np.full(len(members), _VARIABLE, np.uint64)
    for k in range(RUN):
        key = mix(key + own[members[:, k]])
    return np.repeat(key, RUN), members.reshape(-1), np.repeat(together, RUN)


def _count(docs: DataFrame, folder: str, bits: int, min_docs: int, min_tokens: int) -> None:
    """Writes the recurring templates and the first document of each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in store.chunks(batches, "text", 1_000_000):
            keys, lines, fixed, text_of, _ = templates(texts, min_tokens)
            ids = np.array([_NO_ID if i is None else i for i in batch.column("doc_id").to_pylist()], np.int64)
            order = np.lexsort((text_of[lines], keys))
            keys, text, need = keys[order], text_of[lines][order], docs_needed(fixed, min_docs)[order]
            # A template counts once in a text.
            once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])])[: len(keys)]
            keys, first_id, need = keys[once], ids[text[once]], need[once]
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
            if not len(keys):
                continue
            n = np.diff(np.append(start, len(keys))).astype(np.uint32)
            least = np.minimum.reduceat(first_id, start)
            keys, need = keys[start], need[start]
            shards, edges = store.shard_edges(keys, bits)
            rows = [
                {
                    "shard": int(shard),
                    "n": int(hi - lo),
                    "keys": store.pack_sorted(keys[lo:hi]),
                    "docs": store.pack(n[lo:hi]),
                    "need": store.pack(need[lo:hi]),
                    "first": store.pack(least[lo:hi]),
                }
                for shard, lo, hi in zip(shards, edges[:-1], edges[1:], strict=True)
            ]
            names = [(c, pa.binary()) for c in ("keys", "docs", "need", "first")]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("shard", pa.int32()), ("n", pa.int64()), *names]))

    def merge(table: pa.Table) -> pa.Table:
        shard, parts = None, []
        for row in table.to_pylist():
            shard, n = row["shard"], row["n"]
            parts.append(
                (
                    store.unpack_sorted(row["keys"], n),
                    store.unpack(row["docs"], n, np.uint32),
                    store.unpack(row["need"], n, np.uint32),
                    store.unpack(row["first"], n, np.int64),
                )
            )
        keys, docs, need, first = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        total = np.add.reduceat(docs[order].astype(np.int64), start)
        least = np.minimum.reduceat(first[order], start)
        recurs = total >= need[order][start]
        store.save(folder, shard, key=keys[start][recurs], first=least[recurs])
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([int(recurs.sum())], pa.int64())})

    kinds = "shard int, n long, keys binary, docs binary, need binary, first binary"
    partial = docs.select("doc_id", "text").mapInArrow(count, kinds)
    store.seal(folder, partial.groupBy("shard").applyInArrow(merge, "shard int, n long").agg(F.count("n")).first()[0])


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``docs`` (integer doc_id, text and anything else) without recurring lines, with two columns more.

    ``n_lines`` is the number of lines of the given text, ``dropped_lines`` the places (from 0) of those
    that are dropped; ``text`` is what is left. Emptied documents are still there (see ``cleaned``).
    """
    spark = docs.sparkSession
    bits = store.shard_bits(docs.select("doc_id", "text"))
    folder = store.shared_folder(spark, "templates")
    _count(docs, folder, bits, min_docs, min_tokens)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = store.Shards(folder, bits, sealed=True)
        for batch, texts in store.chunks(batches, "text", 1_000_000):
            keys, lines, _, text_of, number = templates(texts, min_tokens)
            ids = np.array([_NO_ID if i is None else i for i in batch.column("doc_id").to_pylist()], np.int64)
            wanted, at = np.unique(keys, return_inverse=True)
            # Absent keys give the largest number as their first document, later than any.
            first = known.find(wanted, ("first", np.int64, _NO_ID))[0][at]
            gone = np.zeros(len(text_of), bool)
            gone[lines[first < ids[text_of[lines]]]] = True
            kept_texts, dropped, totals = [], [], np.bincount(text_of, minlength=len(texts))
            where = np.flatnonzero(gone)
            per_text = np.split(number[where], np.searchsorted(text_of[where], np.arange(1, len(texts))))
            given = batch.column("text").to_pylist()
            for text, places in zip(given, per_text, strict=True):
                dropped.append(places.tolist())
                if not len(places):
                    kept_texts.append(text)
                    continue
                out = set(places.tolist())
                kept_texts.append("\n".join(line for k, line in enumerate(text.split("\n")) if k not in out))
            arrays = [
                pa.array(kept_texts, pa.string()) if name == "text" else batch.column(name) for name in batch.schema.names
            ]
            arrays += [pa.array(totals, pa.int64()), pa.array(dropped, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "n_lines", "dropped_lines"])

    rest = [f for f in docs.schema.fields if f.name not in ("n_lines", "dropped_lines")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return docs.select(*[f"`{f.name}`" for f in rest]).mapInArrow(clean, f"{schema}, n_lines long, dropped_lines array<bigint>")


def cleaned(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """The rows and columns of ``docs`` with cleaned texts, without the documents that have no words left."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    plain = drop_recurring(docs.select("doc_id", "text", others.alias("row")), min_docs, min_tokens)
    empty = ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    left = plain.where(F.col("text").isNull() | (F.size("dropped_lines") == 0) | ~empty)
    return left.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
