"""Packing: an exact round trip against the tokenizer, and near-equal windows."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from searchtide.llm import packing
from searchtide.llm.queries import word_tokenizer
from tests.helpers import tuples
from tests.llm.conftest import documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_tokenizer())


def test_round_trip(odd_docs, library):
    rows = tuples(packing.pack(odd_docs, word_tokenizer(), capacity=64, piece=16, block_tokens=500))
    texts = defaultdict(list)
    for doc_id, text, *_ in documents():
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        texts[doc_id].append(np.array(ids, "<u4"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, total, window, offset in rows:
        pieces[doc_id, total].append((start, length, crc))
        windows[window].append((offset, length))
    for doc_id, versions in texts.items():
        for ids in versions:
            own = sorted(pieces[doc_id, len(ids)])
            copies = sum(len(v) == len(ids) for v in versions)
            at = 0
            for start, length, _ in own[::copies]:
                assert start == at
                at += length
            assert at == len(ids)
            right = {(s, n): zlib.crc32(ids[s : s + n].tobytes()) for s, n, _ in own}
            assert copies > 1 or all(crc == right[s, n] for s, n, crc in own)
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_ids_are_the_tokenizers(library):
    rng = random.Random(0)
    alphabet = "abS'tT rRe1²½ .,!?\"'éÉß÷ª\n\t\x1c\x85\xa0\x00\x7f_-AKs'd'll日ſΣİ́ẞＡ​"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["it's the <|endoftext|> of <|ENDOFTEXT|>", "x" * 200, "We'll don't 'tis"]
    found = packing.WordTokenizer(word_tokenizer()).ids(texts)
    for text, own in zip(texts, found, strict=True):
        assert np.frombuffer(own, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_the_tokenizer_gets_few_words_at_once(monkeypatch, library):
    monkeypatch.setattr(packing, "LEARNT", 4, raising=False)
    tokenizer = packing.WordTokenizer(word_tokenizer())
    given, learn = [], tokenizer._learn
    monkeypatch.setattr(tokenizer, "_learn", lambda words, pieces: given.append(len(words)) or learn(words, pieces))
    texts = [" ".join(f"word{chr(97 + i)}{chr(97 + j)}" for i in range(9)) for j in range(5)] + ["日本 привет й ещё раз два", ""]
    for text, own in zip(texts, tokenizer.ids(texts), strict=True):
        assert np.frombuffer(own, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(given) <= 4 and sum(given) >= 51


def test_small_memory_gives_the_same(monkeypatch, library):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    monkeypatch.setattr(packing, "SEGMENT", 7)
    texts = ["one two three four five six", "", "one two, seven. eight nine ten"] * 3
    found = packing.WordTokenizer(word_tokenizer()).ids(texts)
    for text, own in zip(texts, found, strict=True):
        assert np.frombuffer(own, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_differencing_on_known_numbers():
    # The largest differencing example: 8 7 6 5 4 in two parts leaves 2.
    place = packing.differenced(np.array([8, 7, 6, 5, 4]), 2)
    sums = np.bincount(place, weights=[8, 7, 6, 5, 4])
    assert abs(sums[0] - sums[1]) == 2


@pytest.mark.parametrize("windows", [1, 3, 20])
def test_windows_are_near_equal(windows):
    rng = np.random.default_rng(windows)
    lengths = rng.integers(1, 500, 400)
    sums = np.bincount(packing.differenced(lengths, windows), weights=lengths, minlength=windows)
    assert sums.sum() == lengths.sum()
    assert sums.max() - sums.min() <= max(6, 0.02 * sums.mean())


def test_more_windows_where_capacity_is_exceeded():
    lengths = np.full(5, 60)
    place, offset, n = packing.dealt(lengths, 100)
    assert n == 5 and sorted(place) == [0, 1, 2, 3, 4] and (offset == 0).all()
    assert packing.dealt(np.zeros(0, np.int64), 100)[2] == 0


def test_little_padding():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 513, 8000)
    place, offset, n = packing.dealt(lengths, 4096)
    sums = np.bincount(place, weights=lengths)
    assert sums.max() <= 4096 and lengths.sum() / (n * 4096) > 0.98
