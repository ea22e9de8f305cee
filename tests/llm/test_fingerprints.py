from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from basketlens.llm import fingerprints as fp
from basketlens.llm.words import utf8


def plain_chunks(raw: bytes):
    """Ends of chunks, byte by byte with a rolling hash."""
    ends, start, rolled = [], 0, 0
    for i, byte in enumerate(raw):
        rolled = ((rolled << 1) + int(fp._GEAR[byte])) & 0xFFFFFFFF
        size = i + 1 - start
        bits = fp.STRICT_BITS if size < fp.NORMAL else fp.LOOSE_BITS
        if size == fp.MOST or (size >= fp.LEAST and rolled >> (32 - bits) == 0):
            ends.append(i + 1)
            start = i + 1
    return ends + ([len(raw)] if start < len(raw) else [])


@pytest.fixture(scope="module")
def rows(sentence):
    rng = random.Random(6)
    texts = [sentence(rng, rng.randint(0, 300)) for _ in range(40)]
    texts += [None, "", "é" * 50, "日本語テキスト" * 30, "x", texts[3], "ab" * 3000]
    rng.shuffle(texts)
    return [(i * 5 - 20, t) for i, t in enumerate(texts)]


def test_chunks_equal_a_rolling_hash(rows):
    data, bounds = utf8(pa.array([t for _, t in rows], pa.string()))
    ends, at = fp.chunk_ends(data, bounds)
    for row, (_, text) in enumerate(rows):
        assert (ends[at[row]:at[row + 1]] - bounds[row]).tolist() == plain_chunks((text or "").encode())


def test_an_insertion_moves_few_chunks(sentence):
    text = sentence(random.Random(1), 3000)
    sets = []
    for t in (text, "inserted words " + text, text[:5000] + "!" + text[5000:], sentence(random.Random(2), 3000)):
        sets += fp.chunk_sets(*utf8(pa.array([t])))
    assert fp.containment(sets[0], sets[1]) > 0.95 and fp.containment(sets[0], sets[2]) > 0.95
    assert fp.containment(sets[0], sets[3]) < 0.01
    whole = fp.chunk_sets(*utf8(pa.array([text + sentence(random.Random(2), 3000)])))[0]
    assert fp.containment(sets[0], whole) > 0.95 and 0.4 < fp.containment(whole, sets[0]) < 0.6


@pytest.mark.parametrize("range_rows", [3, 1000])
def test_edited_texts_and_next_documents(documents, rows, range_rows):
    ordered = sorted(rows)
    out = fp.fingerprints(documents([(*r, 0) for r in rows], ", range int"), range_rows).collect()
    found = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    sets = {i: s for (i, _), s in zip(ordered, fp.chunk_sets(*utf8(pa.array([t for _, t in ordered]))))}
    for n, (i, text) in enumerate(ordered):
        j, after = ordered[(n + 1) % len(ordered)]
        text, after = text or "", after or ""
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + after[:quarter]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fp.printed(sets[i])
        own = fp.chunk_sets(*utf8(pa.array([edited])))[0]
        assert r.edited_fingerprint == fp.printed(own)
        assert r.near_edited == fp.containment(sets[i], own)
        assert r.near_next == fp.containment(sets[i], sets[j])


def test_ties_nulls_single_and_empty(documents):
    one = fp.fingerprints(documents([(1, "abcdefgh")])).collect()
    assert one[0].edited_sha256 == sha256(b"abcdefab").hexdigest() and one[0].near_next == 1.0
    assert fp.fingerprints(documents([])).collect() == []
    rows = [(5, "aaaa"), (None, "bbbb"), (5, "aaaa"), (5, "cccc"), (None, None)] * 4
    out = fp.fingerprints(documents(rows), 2).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in rows)
    assert fp.containment(np.zeros(0, np.uint64), np.zeros(0, np.uint64)) == 1.0
