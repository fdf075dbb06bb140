"""BPE encoding and decoding with forced-boundary splitting.

Two neighbouring bytes that occur next to each other inside no vocabulary token can never be merged:
the text may be cut between them, the fragments encoded independently and their ids put one after
another. White space and the borders of pre-tokens are such cuts for this family of vocabularies
(lower case, white space dropped, a mark at the end of a word); the vocabulary's own byte pairs give
the cuts inside a word. Short fragments repeat, so each is merged once and then looked up.

``WordBpe`` reads the tokenizer's normaliser, pre-tokeniser and merges from its file.
Defined results: a null or empty text has no ids and decodes to an empty text; the strings of special
tokens in a text become their ids, as the tokenizers library does it.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from lakepipe.llm import store

MOST_CACHED = 500_000  # words a worker remembers before it starts afresh, some 200 bytes each
AT_ONCE = 4_000  # strings the library encodes in one call; its results take much memory

#: Text of these characters is lower-cased and classified alike by every Unicode library.
BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def newer_than_python(text: str) -> bool:
    """Whether the text has characters that this Python's tables do not know."""
    return not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(BEYOND_LATIN.findall(text)))


def one_thread() -> None:
    """The library's own threads only get in each other's way beside Spark's tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def byte_names() -> list[str]:
    """The character that stands for each byte in such files: itself if it is printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


def encode_apart(tokenizer: Tokenizer, texts: list[str]) -> list[bytes]:
    """Every text's ids as little-endian unsigned 32-bit integers."""
    out = []
    for at in range(0, len(texts), AT_ONCE):
        found = tokenizer.encode_batch(texts[at : at + AT_ONCE], add_special_tokens=False)
        out += [struct.pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in found)]
    return out


class WordBpe:
    """Encoder of one tokenizer file whose white space belongs to no token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        whole = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        self._normalizer, self._pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._split = regex.compile(split).findall
        alphabet = dict(zip(map(chr, range(256)), byte_names(), strict=True))
        self._alphabet = str.maketrans(alphabet)
        self._suffix = spec["model"]["end_of_word_suffix"] or ""
        vocab = spec["model"]["vocab"]
        bare = {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []}
        self._mergers = {
            last: Tokenizer.from_str(
                json.dumps(spec | bare | {"model": spec["model"] | {"end_of_word_suffix": self._suffix if last else None}})
            )
            for last in (True, False)
        }
        inner = [token.removesuffix(self._suffix) if self._suffix else token for token in vocab]
        if any("Ġ" in token and len(token) > 1 for token in inner):  # how such files write a space
            raise ValueError("white space occurs inside tokens: words cannot be encoded apart")
        self.joined = {token[i : i + 2] for token in inner for i in range(len(token) - 1)}
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._find_special = re.compile("(" + "|".join(map(re.escape, self._special)) + ")") if self._special else None
        names = {i: token for token, i in vocab.items()} | {i: token for token, i in self._special.items()}
        spelled = [names.get(i, "").encode() + b" " for i in range(max(names) + 1)]
        self._spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self._lengths = np.array([len(t) for t in spelled], np.int64)
        self._begins = np.cumsum(self._lengths) - self._lengths
        self._ids: dict[bytes, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    def cut(self, piece: str) -> list[str]:
        """The fragments of a pre-token: cut wherever no vocabulary token holds both neighbours."""
        parts, begin = [], 0
        for i in range(1, len(piece)):
            if piece[i - 1 : i + 1] not in self.joined:
                parts.append(piece[begin:i])
                begin = i
        parts.append(piece[begin:])
        return parts

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Merges pre-tokens fragment by fragment; a fragment that several share is merged once."""
        whole, parted = [], {}
        spelled = [p.encode().decode("latin-1").translate(self._alphabet) for p in pieces]
        for piece, spelling in zip(pieces, spelled, strict=True):
            fragments = self.cut(spelling)
            if len(fragments) > 1:
                parted[piece] = fragments
            else:
                whole.append((piece, spelling))
        ends = list(dict.fromkeys([f[-1] for f in parted.values()]))
        inner = list(dict.fromkeys([f for fragments in parted.values() for f in fragments[:-1]]))
        last = encode_apart(self._mergers[True], [s for _, s in whole] + ends)
        self._pieces.update(zip([p for p, _ in whole], last[: len(whole)], strict=True))
        last_ids = dict(zip(ends, last[len(whole) :], strict=True))
        inner_ids = dict(zip(inner, encode_apart(self._mergers[False], inner), strict=True))
        for piece, fragments in parted.items():
            self._pieces[piece] = b"".join([*(inner_ids[f] for f in fragments[:-1]), last_ids[fragments[-1]]])

    def _pieces_of(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens, as plain characters."""
        normal = self._normalizer.normalize_str(text)
        found = self._pre_tokenizer.pre_tokenize_str(normal)
        return [normal[begin:end] for _, (begin, end) in found]

    def _learn(self, words: list[bytes]) -> None:
        """Fills the look-up with new words. Latin ones are normalised in one go and split by the file's own pattern."""
        text = b" ".join(words).decode()
        parts: list[list[str | bytes]] = []
        if len(text.split()) == len(words) and not BEYOND_LATIN.search(text) and not self._has_special(text):
            normal = unicodedata.normalize("NFC", text).lower().split(" ")
            parts = [[w] if w.isalpha() else self._split(w) for w in normal]
        else:
            for word in text.split(" "):
                found: list[str | bytes] = []
                for part in self._find_special.split(word) if self._find_special else [word]:
                    if part in self._special:
                        found.append(struct.pack("<I", self._special[part]))
                    elif part:
                        found += self._pieces_of(part)
                parts.append(found)
        pieces = self._pieces
        self._learn_pieces(list(dict.fromkeys([p for found in parts for p in found if type(p) is str and p not in pieces])))
        for word, found in zip(words, parts, strict=True):
            self._ids[word] = b"".join([pieces[p] if type(p) is str else p for p in found])

    def _has_special(self, text: str) -> bool:
        return bool(self._find_special and self._find_special.search(text))

    def encode_batch(self, texts: list[bytes]) -> list[bytes]:
        """Every text's ids as little-endian unsigned 32-bit integers."""
        if len(self._ids) > MOST_CACHED:
            self._ids = {}
        if len(self._pieces) > MOST_CACHED:
            self._pieces = {}
        split = [text.split() for text in texts]  # bytes split at ASCII white space only
        known = self._ids
        new = list(set().union(*split) - known.keys())
        for at in range(0, len(new), AT_ONCE):
            self._learn(new[at : at + AT_ONCE])
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode_batch(self, texts: list[bytes]) -> list[bytes]:
        """The tokens of each text's ids with a space between: the file names no decoder."""
        ids = np.frombuffer(b"".join(texts), "<u4")
        lengths = self._lengths[ids]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        data = self._spelling[np.arange(ends[-1]) + np.repeat(self._begins[ids] - ends[:-1], lengths)].tobytes()
        cuts = ends[np.concatenate([[0], np.cumsum([len(t) // 4 for t in texts])])].tolist()
        return [data[lo : max(lo, hi - 1)] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(maxsize=1)
def loaded(path: str) -> WordBpe:
    """The encoder of this worker process: its tasks share what it has learnt."""
    one_thread()
    return WordBpe(path)


def encode_and_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded) per row of ``docs`` (doc_id, text); ids are packed little-endian 32-bit integers.

    ``tokenizer`` is the path of the tokenizer file on every worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(tokenizer)
        for batch, texts in store.chunks(batches, "text", 2_000_000):
            ids = bpe.encode_batch(texts)
            decoded = pa.array(bpe.decode_batch(ids), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), decoded], names=["doc_id", "ids", "decoded"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")
