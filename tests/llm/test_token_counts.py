import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lakepipe.llm import queries, token_counts
from lakepipe.session import importable_by_workers

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter(PATH)


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


PIECES = ["a", "b", "é", " ", "  ", "\n", "1", "²", "'s", "'", "ß", "the", "ing", "😀", "語", "​", "́", "<|endoftext|>", "<|"]
PIECES += ["　", "\x1c", "\x85", "꟎", "\U00010940", "!", "\r"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_as_the_library(library, counter, parts):
    text = "".join(parts)
    assert counter.counts([text]) == lengths(library, [text])


@pytest.mark.parametrize(
    "text",
    [
        " " * 1_000_000,
        "\n" * 1_000_000,
        " \n\t" * 100_000,
        "x" * 200_000,
        "ab" * 3_000,
        "aaab" * 900,
        "日本語" * 5_000,
        "".join(random.Random(1).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)),
        "<|endoftext|>" * 50,
    ],
    ids=lambda t: repr(t[:6]),
)
def test_long_pieces(library, counter, text):
    assert counter.counts([text]) == lengths(library, [text])


def by_one_pair_at_a_time(rank_of, merged, symbols):
    symbols = list(symbols)
    while True:
        ranked = [(rank_of.get(p, 1 << 40), i) for i, p in enumerate(zip(symbols, symbols[1:]))]
        rank, at = min(ranked, default=(1 << 40, 0))
        if rank == 1 << 40:
            return len(symbols)
        symbols[at : at + 2] = [merged[rank]]


@pytest.mark.parametrize("long", [1, 3, 400])
def test_rounds_equal_merging_one_pair_at_a_time(monkeypatch, long):
    monkeypatch.setattr(token_counts, "LONG", long)
    random.seed(long)
    pairs, size = {}, 3
    while len(pairs) < 12:
        pair = (random.randrange(size), random.randrange(size))
        if pair not in pairs:
            pairs[pair] = len(pairs)
            size += 1
    merged = {rank: 3 + rank for rank in pairs.values()}
    left, right = np.array(list(pairs)).T
    table = token_counts.PairRanks(left, right, np.array(list(merged.values())))
    sequences = [[random.randrange(3) for _ in range(random.randint(1, 30))] for _ in range(500)]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sequences])])
    got = table.survivors(np.concatenate(sequences), starts)
    assert got.tolist() == [by_one_pair_at_a_time(pairs, merged, s) for s in sequences]


def test_memory_is_given_up_without_a_change(monkeypatch, library, counter):
    monkeypatch.setattr(token_counts, "MOST_KNOWN", 3)
    texts = [f"word{i} and more of it" for i in range(50)]
    assert [counter.counts([t])[0] for t in texts] == lengths(library, texts)


def test_odd_documents(spark, odd_docs, no_docs, library):
    importable_by_workers(spark)
    rows = token_counts.count_tokens(odd_docs, PATH, limit=10).collect()
    given_texts = [(r["doc_id"], r["text"] or "") for r in odd_docs.select("doc_id", "text").collect()]
    want = [
        (i, len(t.encode()), n, n > 10) for (i, t), n in zip(given_texts, lengths(library, [t for _, t in given_texts]), strict=True)
    ]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert token_counts.count_tokens(no_docs, PATH).count() == 0


def test_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = dict(zip(texts, lengths(library, list(texts.values())), strict=True))
    rows = queries.op12_token_counts(spark, folder).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) and r["n_bytes"] == len(texts[r["doc_id"]].encode()) for r in rows)


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        token_counts.TokenCounter(public_tokenizers.path("word_bpe_49k.json"))
