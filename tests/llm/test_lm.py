from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import lm

ASCII_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def part():
    return F.expr("CASE WHEN doc_id % 5 = 1 THEN 0 WHEN doc_id % 5 = 2 THEN 2 ELSE 1 END")


def part_of(i):
    return {1: 0, 2: 2}.get(i % 5, 1)


def plain_scores(rows):
    """Base and mixed scores with counts in dictionaries and the weights found from single tokens."""
    stream = {i: ["END", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII_LOWER)), "END"]
              for i, t in rows}
    counts = {p: (Counter(), Counter()) for p in (1, 2)}
    for i, s in stream.items():
        if part_of(i):
            counts[part_of(i)][0].update(s[1:])
            counts[part_of(i)][1].update(zip(s, s[1:]))
    one, two = (counts[1][k] + counts[2][k] for k in (0, 1))
    total, words = sum(one.values()), len(one)
    size = lambda c: float(lm.class_size(lm.size_class(np.array([c])))[0])
    events = [(size(counts[1][1][a, b]), size(counts[1][0][a]), size(counts[1][0][b]))
              for i, s in stream.items() if part_of(i) == 2 for a, b in zip(s, s[1:])]
    rest = sum(counts[1][0].values())
    weights = {}
    for b in range(lm.CONTEXT_BUCKETS):
        own = [(p / max(c, 1), t / max(rest, 1), (t + .5) / (rest + .5 * (words + 1)))
               for p, c, t in events if min(int(math.log2(c + 1)), lm.CONTEXT_BUCKETS - 1) == b]
        w = list(lm.PRIOR)
        for _ in range(lm.EM_STEPS if own else 0):
            g = [sum(e[k] * w[k] / sum(x * y for x, y in zip(e, w)) for e in own) for k in range(3)]
            w = [max(x / sum(g), lm.LEAST_WEIGHT) for x in g]
            w = [x / sum(w) for x in w]
        weights[b] = w
    out = {}
    for i, s in stream.items():
        base = mix = 0.0
        for a, b in zip(s, s[1:]):
            low = (one[b] + .5) / (total + .5 * (words + 1))
            w = weights[min(int(math.log2(one[a] + 1)), lm.CONTEXT_BUCKETS - 1)]
            base += math.log10(low)
            mix += math.log10(w[0] * two[a, b] / max(one[a], 1) + w[1] * one[b] / max(total, 1) + w[2] * low)
        out[i] = (len(s) - 1, sum(one[x] > 0 for x in s[1:]), total, base, mix)
    return out


@pytest.fixture(scope="module")
def rows(sentence):
    rng = random.Random(2)
    pool = sentence(rng, 60).split()
    rows = [(i, " ".join(rng.choice(pool[:rng.choice((5, 60))]) for _ in range(rng.randint(0, 60)))
             + (" " + sentence(rng, 3) if i % 3 == 0 else "")) for i in range(150)]
    return rows + [(150, None), (151, ""), (152, " \t\n"), (153, "THE the The\x85x"), (154, "the " * 500)]


@pytest.mark.parametrize("batch_rows", [11, 10_000])
def test_scores_equal_plain_counts(documents, rows, batch_rows):
    out = lm.scores(documents([(*r, "z") for r in rows], ", batch string"), part(), batch_rows).collect()
    expected = plain_scores(rows)
    assert len(out) == len(rows)
    for r in out:
        n, known, total, base, mix = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, part_of(r.doc_id) == 0)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(mix, rel=1e-6)


def test_mixture_beats_the_base_on_held_out_texts(documents, rows):
    out = [r for r in lm.scores(documents(rows), part()).collect() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_no_training_rows_nulls_repeats_and_empty(documents):
    out = lm.scores(documents([(1, "a b"), (1, "a b"), (6, None)]), part()).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in out) == [(1, 0, 0), (3, 0, 0), (3, 0, 0)]
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in out)
    twice = lm.scores(documents([(3, "a"), (3, "a"), (None, "a")]), F.lit(1)).collect()
    assert {r.train_tokens for r in twice} == {6}
    assert lm.scores(documents([]), part()).collect() == []


def test_packing():
    values = np.array([0, 1, 255, 256, 2**63 + 5], np.uint64)
    assert (lm.unpacked(lm.packed(values)) == values).all()
