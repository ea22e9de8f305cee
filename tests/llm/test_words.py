from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import words
from basketlens.llm.words import ALPHANUMERIC, VISIBLE, shingles, slices, word_hashes

PATTERNS = {"alphanumeric": (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
            "visible": (VISIBLE, r"[^\x20\x09-\x0D]+")}
ASCII_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def plain(text, pattern):
    return re.findall(pattern, (text or "").translate(ASCII_LOWER))


@pytest.mark.parametrize("kind", PATTERNS)
@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("abAB1 .\n\téß-É"), max_size=30)), max_size=6))
def test_words_are_the_pattern_s_words(kind, texts):
    alphabet, pattern = PATTERNS[kind]
    hashes, counts = [], []
    for _, _, data, offsets in slices(pa.array(texts, pa.string())):
        found, starts, ends, bounds = word_hashes(data, offsets, alphabet)
        hashes += found.tolist()
        counts += np.diff(bounds).tolist()
        raw = data.tobytes()
        spelled = [raw[a:b].decode().translate(ASCII_LOWER) for a, b in zip(starts, ends)]
    expected = [plain(t, pattern) for t in texts]
    assert counts == [len(e) for e in expected]
    flat = [w for e in expected for w in e]
    if texts:
        assert spelled == flat
    assert len(set(zip(flat, hashes))) == len(set(flat)) == len(set(hashes))


def test_long_texts_are_cut_between_words_only(monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 16)
    texts = ["one two three four five six seven", "x" * 70, None, "", "a b " * 20]
    whole = words.word_hashes(*_all(texts), ALPHANUMERIC)
    monkeypatch.setattr(words, "SLICE_BYTES", 1 << 20)
    for one, two in zip(whole, words.word_hashes(*_all(texts), ALPHANUMERIC)):
        assert (one == two).all()


def _all(texts):
    data, bounds = words.utf8(pa.array(texts, pa.string()))
    return data, bounds


def test_shingles_of_short_rows_and_rows_do_not_mix():
    data, bounds = _all(["a b c d e f", "a b", "", "b c d e f", "a b"])
    hashes, _, _, at = word_hashes(data, bounds, ALPHANUMERIC)
    grams, rows = shingles(hashes, at, 5)
    assert np.diff(rows).tolist() == [2, 1, 0, 1, 1]
    assert grams[1] == grams[3] and grams[2] == grams[4] and len(set(grams.tolist())) == 3
