from __future__ import annotations

import random
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import private

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(d) for d in digits])):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            keep = (True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                    14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)[kind]
            if keep:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("a1 @.-+()é0\n5%"), max_size=40))
def test_base_spans_are_the_patterns_matches(text):
    assert private.base_spans(text) == plain_spans(text)


CASES = ["write ann.b@mail.example.com, or a@b@c.de and x@y", "4539 1488 0343 6467 and 4539148803436468",
         "10.0.0.255 1.2.3.4.5 999.1.1.1 0001.1.1.1", "+1 (980) 555-6268 +12 +1 2", "é 10.1.1.1 ü a@b.c"]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_of_cases(text):
    assert private.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "+1" * 100_000, "a@" * 100_000):
        private.base_spans(text)


def test_gradients():
    rng = np.random.default_rng(0)
    model = private.fresh_tagger(kind=float)
    codes = rng.integers(1, private.CLASSES, (3, 12)).astype(np.uint8)
    tags = np.array([[0, 1, 2, 2, 0, 3, 4, 0, 0, 7, 8, 0]] * 3)
    _, gradients = private.loss_gradient(model, codes, tags)
    for weights, gradient in zip(model.arrays(), gradients):
        at = np.unravel_index(np.abs(gradient).argmax(), weights.shape)
        slope = []
        for step in (1e-5, -1e-5):
            weights[at] += step
            slope.append(private.loss_gradient(model, codes, tags)[0])
            weights[at] -= step
        assert (slope[0] - slope[1]) / 2e-5 == pytest.approx(gradient[at], rel=1e-4)


def test_marginals_and_best_path_equal_all_sequences():
    import itertools
    rng = np.random.default_rng(1)
    moves = (rng.normal(size=(private.TAGS + 1, private.TAGS)) + private.ALLOWED)
    scores = rng.normal(size=(1, 3, private.TAGS))
    alpha, beta, total = private.forward_backward(scores, moves)
    weight = {}
    for tags in itertools.product(range(private.TAGS), repeat=3):
        weight[tags] = moves[0, tags[0]] + sum(scores[0, t, k] for t, k in enumerate(tags)) + sum(
            moves[a + 1, b] for a, b in zip(tags, tags[1:]))
    values = np.exp(np.array(list(weight.values())))
    assert total[0] == pytest.approx(np.log(values.sum()))
    second = sum(np.exp(v) for k, v in weight.items() if k[1] == 0) / values.sum()
    assert np.exp(alpha + beta - total)[0, 1, 0] == pytest.approx(second)


def test_reconciled_spans_weigh_most():
    spans = [(0, 0, 10, .9), (8, 1, 20, .99), (20, 0, 25, .95), (0, 0, 10, .97), (9, 2, 12, 1.0)]
    assert private.reconcile(spans) == [(8, 1, 20), (20, 0, 25)]
    assert private.reconcile([]) == []


@pytest.fixture(scope="module")
def texts(sentence):
    rng, out = random.Random(3), []
    for i in range(500):
        words = sentence(rng, rng.randint(10, 60)).split()
        if i % 2:
            words[rng.randrange(len(words))] = rng.choice([
                f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
                f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.7",
                f"{words[0]}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com"])
        elif i % 5 == 0:
            words[0] = f"version {rng.randint(1, 9)}.{rng.randint(0, 9)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def model(texts):
    return private.fit_tagger(*private.labelled_windows(texts), epochs=24)


def test_model_finds_held_out_spans_and_other_forms(model, texts, sentence):
    rng = random.Random(9)
    fresh = [f"{sentence(rng, 8)} ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} {sentence(rng, 8)}"
             for _ in range(50)]
    found = private.model_spans(model, fresh, [private.base_spans(t) for t in fresh], 0.8)
    assert sum(any(t[a] == "(" and t[b - 1].isdigit() and k == 3 for a, k, b in s)
               for t, s in zip(fresh, found)) >= 35
    clean = [sentence(rng, 30) + f" in {rng.randint(1, 99)} words" for _ in range(50)]
    assert sum(map(len, private.model_spans(model, clean, [[]] * 50))) <= 1


@pytest.mark.parametrize("address", [
    "first.last(@)dept.of.physics.example.com",
    "first.last (at) dept.of.physics.example.com",
    "first.middle.last(@)group.of.particles.dept.of.physics.university.example.com"])
def test_long_addresses_are_found_wherever_they_start(model, sentence, address):
    rng = random.Random(21)
    before, after = sentence(rng, 60), sentence(rng, 40)
    texts = [f"{before[:shift]} {address} {after}" for shift in range(100, 164)]
    found = private.model_spans(model, texts, [[]] * 64, 0.8)
    whole = sum((t.index(address), 0, t.index(address) + len(address)) in s for t, s in zip(texts, found))
    assert whole >= 58


def test_rows_with_at_in_words_are_read(model):
    column = pa.array(["none", "a (at) b", None, "(a t)", "at", "8"])
    assert [r[0] for r in private._found(column, model)] == [1, 5]


def test_long_base_spans_are_taught_whole():
    address = "someone.with.a.long.name@dept.of.physics.university.example.com"
    codes, tags = private.labelled_windows([f"write to {address} now"] * 40)
    assert {1, 2} <= set(tags.ravel()) and (tags > 0).sum(axis=1).max() > private.STEP
    assert len({t.tobytes() for t in tags}) > 3  # rewritten forms differ in length


def test_table_of_spans(documents, model, texts):
    rows = list(enumerate([*texts[:60], None, "", *CASES])) + [(0, texts[0]), (None, CASES[2])]
    out = private.personal_data(documents([(*r, 1) for r in rows], ", n_email int"), model).collect()
    assert len(out) == len(rows)
    for r, (i, text) in zip(sorted(out, key=lambda r: str(r.doc_id)), sorted(rows, key=lambda r: str(r[0]))):
        base = plain_spans(text or "")
        listed = [f"{private.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans) and len(spans) == len(listed) + r.n_added


def test_redaction_keeps_rows_columns_and_clean_texts(documents):
    rows = [(1, "a@b.cd is 10.0.0.1", 18), (2, "clean 5", 7), (3, None, None), (4, "", 0)]
    frame = documents(rows, ", n_chars int")
    out = private.redacted(frame, None)
    assert out.schema == frame.schema
    assert [tuple(r) for r in sorted(out.collect())] == [(1, "[EMAIL] is [IP]", 15), *rows[1:]]


def test_no_labelled_spans_no_model(documents):
    assert private.train(documents([(1, "nothing 5"), (2, None)])) is None
    assert private.personal_data(documents([]), None).collect() == []


def test_marginals_of_a_very_long_stretch():
    rng = np.random.default_rng(6)
    moves = (rng.normal(size=(private.TAGS + 1, private.TAGS)) + private.ALLOWED).astype(np.float32)
    scores = (3 * rng.normal(size=(1, 200_000, private.TAGS))).astype(np.float32)
    tags, sure = private.decode(scores, moves)
    assert (sure >= 0).all() and sure.max() <= 1 + 1e-3
    # The first characters' marginals do not depend on what comes long after them.
    near, few = private.decode(scores[:, :400].astype(np.float64), moves.astype(np.float64))
    assert (near[0, :300] == tags[0, :300]).all()
    assert np.abs(few[0, :300] - sure[0, :300]).max() < 1e-3
    alpha, beta, total = private.forward_backward(scores[:, :400].astype(np.float64), moves)
    exact = np.exp(alpha + beta - total[:, None, None])
    own = np.take_along_axis(exact, near[:, :, None].astype(np.int64), 2)[0, :, 0]
    assert np.abs(own - few[0]).max() < 1e-6


def test_masking_replaces_only_changed_rows(spark, monkeypatch):
    from basketlens.llm import words
    monkeypatch.setattr(words, "SLICE_BYTES", 64)
    texts = [None, "", "plain " * 30, "mail a.b@mail.example.com now", "x" * 300, "ip 10.0.0.1"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array([None if t is None else len(t) for t in texts], pa.int64()),
         pa.array(range(6))], names=["text", "n_chars", "other"])
    found = pa.Table.from_batches(private._redact(iter([batch.slice(0, 4), batch.slice(4)]), None, 0, 1))
    assert found.column("text").to_pylist() == [
        None, "", texts[2], "mail [EMAIL] now", texts[4], "ip [IP]"]
    assert found.column("n_chars").to_pylist() == [None, 0, 180, 16, 300, 7]
    assert found.column("other").to_pylist() == list(range(6))
