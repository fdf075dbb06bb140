import hashlib
import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lakepipe.llm import bpe, packing, queries

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
ODD = [
    "", " ", "\n", "a  b", "a\n\nb c", "  lead", "trail ", "x\ty", "he's I'LL don't", "\xa0\xa0 a\xa0 b  c", "é ́x",
    "<|endoftext|> a<|startoftext|>b <|endoftext|>", "ÀÉ ñandú ΑΣ Σ ΣΑΣ İstanbul", "日本語 テスト 123,456.78", "a\x1cb \x85",
    "Ünïcödé—dash…", "%%% &&& a!!b?!", "a   b    c", "​ zero", "😀😀 ok", "\x00 x", "'s 's'", "ab\n cd", "ab \ncd",
    "x" * 5000, "word, " * 500,
]
any_text = st.text(alphabet=st.one_of(st.sampled_from("aAbzé'ñ \n\t.,!1<|>😀ßΣ"), st.characters(codec="utf-8")), max_size=40)


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def word():
    return bpe.WordBpe(WORD), library(WORD)


@pytest.fixture(scope="module")
def byte():
    return packing.ByteBpe(BYTE), library(BYTE)


def same_as_library(pair, texts):
    own, lib = pair
    for ids, text in zip(own.encode_batch([t.encode() for t in texts]), texts):
        want = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.decode_batch([ids])[0].decode() == lib.decode(want, skip_special_tokens=False)


def test_words_as_the_library_does(word):
    same_as_library(word, ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(any_text, max_size=4))
def test_any_words_as_the_library_does(word, texts):
    same_as_library(word, texts)


@settings(max_examples=300, deadline=None)
@given(any_text)
def test_any_bytes_as_the_library_does(byte, text):
    assert byte[0].encode(text.encode()).tolist() == byte[1].encode(text, add_special_tokens=False).ids


def test_forced_cuts_are_where_no_token_has_the_pair(word):
    own, _ = word
    vocab = own._mergers[True].get_vocab()
    for piece in ("hello", "qxzj", "ÃĤÃĹ", "abcxqz"):
        parts = own.cut(piece)
        assert "".join(parts) == piece
        at = 0
        for part in parts[:-1]:
            at += len(part)
            pair = piece[at - 1 : at + 1]
            assert not any(pair in token.removesuffix("</w>") for token in vocab)
    assert own.cut("hello") == ["hello"] and len(own.cut("qxzj")) > 1


def test_a_word_learnt_twice_is_the_same(word):
    own, _ = word
    first = own.encode_batch([b"zebra zebra"])[0]
    own._ids, own._pieces = {}, {}
    assert own.encode_batch([b"zebra zebra"])[0] == first


def test_round_trip_query(spark):
    lib = library(WORD)
    docs = {d["doc_id"]: d["text"] for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op4_bpe_round_trip(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = lib.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows_are_encoded(odd_docs, no_docs):
    rows = bpe.encode_and_decode(odd_docs, WORD).collect()
    assert len(rows) == odd_docs.count()
    assert all(not r["ids"] and r["decoded"] == "" for r in rows if r["doc_id"] in (0, 1, 2))
    assert bpe.encode_and_decode(no_docs, WORD).count() == 0


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_each_cell_once_and_steps_to_a_neighbour(dimensions, bits):
    axes = np.meshgrid(*[np.arange(2**bits)] * dimensions, indexing="ij")
    cells = np.stack([a.reshape(-1) for a in axes], axis=1)
    keys = packing.hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1).max() == 1


def holds_all(rows, texts, lib, length):
    """Every token lies in exactly one piece, and every sequence is gapless."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc, parts in pieces.items():
        ids = [*(lib.encode(texts[doc] or "", add_special_tokens=False).ids), 0]
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    fills = []
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
        fills.append(at)
    assert sum(f < length for f in fills) <= 1


def test_packing_query(spark, byte):
    docs = {d["doc_id"]: d["text"] for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    holds_all(queries.op5_curve_packing(spark, SMALL).collect(), docs, byte[1], 1024)


def test_odd_rows_are_packed(odd_docs, no_docs, byte):
    single = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    holds_all(packing.pack(single, BYTE, 64).collect(), texts, byte[1], 64)
    assert packing.pack(no_docs, BYTE).count() == 0
    every = packing.pack(odd_docs, BYTE, 64).collect()
    assert sum(r["start"] == 0 for r in every) == odd_docs.count()


def test_neighbours_on_the_curve_are_similar():
    rng = np.random.default_rng(3)
    topics = [rng.integers(0, 50_000, 60) for _ in range(12)]
    docs = [rng.choice(topics[k % 12], 400) for k in range(240)]
    order = np.argsort(packing.curve_keys(docs))
    same = np.mean(np.diff(order % 12) == 0)
    assert same > 3 / 12


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, " \n\t" * 400_000, " " * 19_999 + "x", "\U00010940 \u0558a"], ids=lambda t: repr(t[:3]))
def test_long_white_space_and_new_characters(text):
    whole = Tokenizer.from_file(BYTE)
    assert packing.ByteBpe(BYTE).encode(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids
