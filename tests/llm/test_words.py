import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lakepipe.llm import store
from lakepipe.llm.words import buffer_of, shingles, words_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
alphabet = st.text(alphabet="aAbZ\t\n \x0b\x1céß ", max_size=30)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@settings(max_examples=200, deadline=None)
@given(st.lists(alphabet, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    words = words_of(*buffer_of([t.encode() for t in texts]))
    want = [WORDS.findall(lower(t)) for t in texts]
    assert np.diff(words.starts).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(flat)) == len(set(words.hashes.tolist()))
    assert dict(zip(flat, words.hashes.tolist())) | {} == dict(zip(flat, words.hashes.tolist()))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=12), min_size=1, max_size=5), st.integers(1, 4))
def test_shingles_are_word_windows(texts, width):
    grams, owner = shingles(words_of(*buffer_of([t.encode() for t in texts])), width)
    want = []
    for t in texts:
        w = t.split()
        want.append([tuple(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [tuple(w)] if w else [])
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(g) for g in want]
    flat = [g for gs in want for g in gs]
    assert len(set(flat)) == len(set(grams.tolist())) == len(set(zip(flat, grams.tolist())))


def test_packing_keeps_numbers():
    for dtype in (np.uint32, np.uint64):
        keys = np.unique(np.random.default_rng(1).integers(0, np.iinfo(dtype).max, 1000, dtype=dtype))
        assert (store.unpack_sorted(store.pack_sorted(keys), len(keys), dtype) == keys).all()
        assert (store.unpack(store.pack(keys), len(keys), dtype) == keys).all()


def test_look_ups_in_shards(tmp_path):
    keys = np.unique(np.random.default_rng(2).integers(0, 2**64, 5000, dtype=np.uint64))
    shards, edges = store.shard_edges(keys, 5)
    for shard, lo, hi in zip(shards, edges[:-1], edges[1:]):
        if shard != 3:
            store.save(str(tmp_path), int(shard), key=keys[lo:hi], value=(keys[lo:hi] >> np.uint64(40)).astype(np.int64))
    store.save(str(tmp_path), 3, key=keys[:0], value=np.zeros(0, np.int64))
    found = store.Shards(str(tmp_path), 5).find(keys, ("value", np.int64, -1))[0]
    inside = (keys >> np.uint64(59)) != 3
    assert (found[inside] == (keys[inside] >> np.uint64(40)).astype(np.int64)).all() and (found[~inside] == -1).all()


def test_tasks_need_the_record_of_a_sealed_folder(tmp_path):
    keys = np.arange(1, 10, dtype=np.uint64) << np.uint64(59)
    for k in range(1, 10):
        store.save(str(tmp_path), k, key=keys[k - 1 : k], value=np.full(1, float(k)))
    with pytest.raises(FileNotFoundError):
        store.Shards(str(tmp_path), 5, sealed=True)
    with pytest.raises(FileNotFoundError):
        store.seal(str(tmp_path), 10)
    store.seal(str(tmp_path), 9)
    for sealed in (True, False):
        assert store.Shards(str(tmp_path), 5, sealed=sealed).find(keys, "value")[0].tolist() == list(range(1, 10))
    (tmp_path / "key-4.npy").rename(tmp_path / "elsewhere.npy")
    with pytest.raises(FileNotFoundError):
        store.Shards(str(tmp_path), 5, sealed=True).find(keys, "value")
