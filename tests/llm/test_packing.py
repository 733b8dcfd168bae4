import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from codesift.llm import packing

from .conftest import odd_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def words():
    return packing.WordIds(PATH)


def ids_of(words, text):
    return np.frombuffer(words.of(text.encode()), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.characters(codec="utf-8"), max_size=40))
def test_ids_of_any_text(words, whole, text):
    assert ids_of(words, text) == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "", "it's REALLY don't''t", "a<|endoftext|>b <|startoftext|>", "İx ﬁ é́ 12½ ²",
    "a b c\x1cd\x85e", "naïve Œuvre Straße", "x" * 300, "hello,world!!! 3.14"])
def test_ids_of_odd_texts(words, whole, text):
    assert ids_of(words, text) == whole.encode(text, add_special_tokens=False).ids


def test_known_words_may_be_dropped(whole, monkeypatch):
    monkeypatch.setattr(packing, "_KEPT_WORDS", 3)
    words = packing.WordIds(PATH)
    text = "many different words here and more words here again"
    for _ in range(2):
        assert ids_of(words, text) == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_patterns_use_up_the_histogram(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(20)}
    patterns = packing.shortest_pack_first(histogram, 64)
    used = defaultdict(int)
    for count, pattern in patterns:
        assert sum(length * copies for length, copies in pattern) <= 64
        for length, copies in pattern:
            used[length] += count * copies
    assert used == histogram
    places = packing.slots(patterns)
    for length, n in histogram.items():
        ranges = sorted((low, count) for size, low, count, _, _ in places if size == length)
        assert ranges[0][0] == 0


def check_packed(rows, texts, whole, size):
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    for doc_id, found in texts.items():
        want = []
        for text in found:
            ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
            for start in range(0, len(ids), size):
                piece = ids[start: start + size]
                want.append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens)
                      for r in by_doc[doc_id]) == sorted(want)
    return len(sequences)


@pytest.mark.parametrize("size", [64, 2048])
def test_packed(odd, whole, size):
    texts = defaultdict(list)
    for row in odd_rows():
        texts[row[0]].append(row[1])
    rows = packing.packed(odd, PATH, size).collect()
    check_packed(rows, texts, whole, size)


def test_little_padding(make, whole):
    rng = random.Random(5)
    texts = {i: [" ".join(rng.choice(["tree", "house", "lake"]) for _ in range(rng.randint(1, 90)))]
             for i in range(400)}
    rows = packing.packed(make([(i, t[0]) for i, t in texts.items()]), PATH, 128).collect()
    n = check_packed(rows, texts, whole, 128)
    assert sum(r.length for r in rows) >= 0.95 * 128 * n


def test_no_documents(none):
    assert packing.packed(none, PATH).count() == 0
