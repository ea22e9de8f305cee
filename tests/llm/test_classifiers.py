from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.llm import language, quality, toxicity

INSULTS = ["fool", "rotten", "vile"]


@pytest.fixture(scope="module")
def rows(sentence):
    rng, out = random.Random(5), []
    for i in range(900):
        words = sentence(rng, rng.randint(5, 60)).split()
        toxic, junk = int(i % 6 == 0), int(i % 4 == 1)
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        if junk:
            words = [w + "$$$" for w in words] if i % 8 == 1 else words[:2] * 20 + INSULTS[:toxic]
        out.append((i, " ".join(words), 1 - junk, toxic))
    return out


@pytest.fixture(scope="module")
def tables(spark, rows):
    docs = spark.createDataFrame([(i, t, "s") for i, t, _, _ in rows] + [(2000, None, "s"), (2001, "", "s")],
                                 "doc_id long, text string, p_toxic string")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows if i < 600]
                                   + [(5, None, None), (None, 1, 1), (7, rows[7][2], rows[7][3])],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_toxicity_on_rows_without_labels(tables, rows):
    docs, labels = tables
    model = toxicity.train(docs, labels)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(out) == len(rows) + 2
    wrong = [i for i, _, _, x in rows[600:] if out[i].toxic != bool(x)]
    assert len(wrong) <= 3
    assert not out[2000].toxic and out[2000].p_toxic == out[2001].p_toxic
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in out.items() if not r.toxic)


def test_later_categories_use_earlier_ones():
    rng = np.random.default_rng(1)
    first = rng.integers(0, 2, 3000)
    row, bucket = np.flatnonzero(first), np.full(int(first.sum()), 77)
    labels = np.column_stack([first, first])
    model = toxicity.fit_chain(["a", "b"], labels, row, bucket, rng.integers(0, 5, 3000))
    assert model.chain_weights[1, 0] > 0 and model.chain_weights[0].sum() == 0
    none = toxicity.fit_chain(["a"], np.zeros((0, 1), np.int64), row[:0], bucket[:0], row[:0])
    assert none.intercepts[0] == -40


def test_toxicity_without_labels_or_rows(spark, tables):
    docs, labels = tables
    model = toxicity.train(docs, labels.where("false"))
    assert not any(r.toxic for r in toxicity.score(docs, model).collect())
    assert toxicity.score(docs.where("false"), model).collect() == []


def test_quality_on_rows_without_labels(spark, tables, rows):
    docs, labels = tables
    model = quality.train(quality.sample_of(docs, labels))
    marked = docs.selectExpr("doc_id", "doc_id >= 600 AS held_out", "text", "p_toxic AS score")
    out = {r.doc_id: r for r in quality.rate(marked, model).collect()}
    assert len(out) == len(rows) + 2
    wrong = [i for i, _, q, _ in rows[600:] if out[i].predicted != q]
    assert len(wrong) <= 9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    assert out[2000].score == out[2001].score
    assert quality.rate(marked.where("false"), model).collect() == []


def test_quality_without_both_labels(spark, tables):
    docs, labels = tables
    for rule, share in (("false", 0.5), ("quality = 1", 1.0)):
        model = quality.train(quality.sample_of(docs, labels.where(rule)))
        score = quality.rate(docs.selectExpr("doc_id", "true AS held_out", "text"), model).first().score
        assert score == pytest.approx(share, abs=1e-3)


def test_a_repeated_id_is_one_row_of_the_sample(spark, tables, monkeypatch):
    docs, labels = tables
    docs = docs.unionByName(spark.range(400).selectExpr(
        "3L AS doc_id", "concat('text ', id) AS text", "'s' AS p_toxic"))
    assert quality.sample_of(docs, labels).count() == 600
    seen = []
    monkeypatch.setattr(toxicity, "fit_chain", lambda names, y, *rest: seen.append(len(y)))
    toxicity.train(docs, labels)
    assert seen == [600]


def test_every_labelled_row_is_paired(spark):
    """Labels far beyond the former 20,000 rows, of which a few are of label 0."""
    few = 30
    measured = spark.range(25_000).select(
        "id", (F.col("id") >= few).cast("int").alias("quality"),
        F.array(*[((F.col("id") * 7 + k) % 11 / 11).cast("double") for k in range(quality.N_BASE)]).alias("x")
    ).toDF("doc_id", "quality", "x")
    dealt, bad, good = quality._dealt(measured)
    assert (bad, good) == (few, 25_000 - few) and dealt.where("first").count() == 25_000
    blocks = dealt.groupBy("block").agg(F.count_if(F.col("quality") == 0).alias("bad"), F.count("*").alias("n")).collect()
    assert len(blocks) == 12 and min(r.bad for r in blocks) == few and max(r.n for r in blocks) < 3_000
    rows = quality._pairs_of(np.arange(100.0)[:, None], np.repeat([1, 0], [3, 97]), 0)
    assert len(rows) == 120
    held = np.eye(500)
    pairs = quality._pairs_of(held, np.repeat([1, 0], [5, 495]), 1)
    assert (np.abs(pairs).sum(axis=0) > 0).all()


def test_quality_learns_alike_from_features_and_texts(tables):
    docs, labels = tables
    one, two = quality.learn(docs, labels), quality.train(quality.sample_of(docs, labels))
    assert one.weights == pytest.approx(two.weights) and one.threshold == pytest.approx(two.threshold)


def test_pair_fit_orders_by_preference():
    rng = np.random.default_rng(0)
    differences = rng.normal(size=(2000, 3)) + [1, 0, -0.5]
    weights = quality.fit_pairs(differences)
    assert weights[0] > 0.3 and weights[2] < -0.1 and abs(weights[1]) < 0.15


def tongue(rng, letters, count):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(count))


def test_languages_are_told_apart(spark):
    rng = random.Random(7)
    letters = {"xx": "abcdehl", "yy": "abcmnoé", "zz": "nopqrsß"}
    rows = [(i, tongue(rng, letters[name], rng.randint(4, 50)), name)
            for i, name in enumerate(list(letters) * 100)]
    docs = spark.createDataFrame(rows + [(900, None, "xx"), (901, "12 .", "yy"), (902, "", None), (903, "½", "xx"),
                                         (904, "абв", None)], "doc_id long, text string, lang string")
    model = language.learn(docs.where("doc_id % 4 <> 2"))
    assert model.languages == ("xx", "yy", "zz") and (model.false_rate < 0.2).all()
    out = {r.doc_id: r for r in language.predict(docs.selectExpr(
        "doc_id", "doc_id % 4 = 2 AS held_out", "text", "lang AS score"), model).collect()}
    wrong = [i for i, _, name in rows if out[i].lang_pred != name and i % 4 == 2]
    assert len(wrong) <= 1 and all(0 <= r.score <= 1 for r in out.values())
    assert {i for i, r in out.items() if r.lang_pred == "und"} == {900, 901, 902, 903}
    assert out[904].lang_pred == "xx"  # no n-gram tells: the first


def test_nothing_taught_and_empty(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = language.learn(docs)
    marked = docs.selectExpr("doc_id", "false AS held_out", "text")
    assert [r.lang_pred for r in language.predict(marked, model).collect()] == ["und"]
    assert language.predict(marked.where("false"), model).collect() == []


def plain_grams(text: str) -> list[bytes]:
    """N-grams one by one: lower-case letters and bytes from 128 on, the rest as blanks."""
    data = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
                 for b in (text or "").encode())
    whole = [data[i:i + 4] for i in range(len(data) - 3)]
    return [g for g in whole if sum(b != 32 for b in g) >= 2]


def plain_filters(rows) -> dict[str, set[bytes]]:
    """The n-grams that each language holds, by dictionaries of counts."""
    seen = {}
    for text, lang in rows:
        if lang is not None and text is not None:
            seen.setdefault(lang, Counter()).update(plain_grams(text))
    rate = {n: {g: k / sum(c.values()) for g, k in c.items()} for n, c in seen.items()}
    mean = Counter()
    for rates in rate.values():
        for gram, r in rates.items():
            mean[gram] += r / len(seen)
    return {n: {g for g, k in c.items() if k >= 3 and rate[n][g] >= 2.0 ** -18
                and rate[n][g] > 1.5 * mean[g] - 1e-12} for n, c in seen.items()}


def test_seventy_languages_against_plain_sets(spark):
    rng, letters = random.Random(3), "abcdefghijklmnopqrstuvwxyzäöüßéñ"
    own = {f"l{i:02}": "".join(rng.sample(letters, 4)) for i in range(70)}
    rows = [(i, tongue(rng, own[name], rng.randint(30, 90)), name) for i, name in enumerate(list(own) * 12)]
    rows += [(5000, None, "l00"), (5001, "..", "l01"), (5002, "", "l02")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.learn(docs.where("doc_id % 4 <> 2"))
    assert model.languages == tuple(sorted(own)) and model.slots.shape == (2, 1 << language.SLOT_BITS)
    plain = plain_filters([(t, n) for i, t, n in rows if i % 4 != 2])
    for number, name in enumerate(sorted(plain)):
        keys = np.array(sorted(int.from_bytes(g, "big") for g in plain[name]), np.uint64)
        bits = language.masks_of(model.slots, keys)[number // 64] >> np.uint64(number % 64) & np.uint64(1)
        assert bits.all(), name  # no false negatives
    out = {r.doc_id: r for r in language.predict(docs.selectExpr(
        "doc_id", "doc_id % 4 = 2 AS held_out", "text"), model).collect()}
    for i, text, _ in rows[::7]:
        found = plain_grams(text)
        if not found:
            continue
        share = [sum(g in plain[n] for g in found) / len(found) for n in sorted(plain)]
        best = max(share)  # the correction for false positives tells equal shares apart
        assert share[sorted(plain).index(out[i].lang_pred)] >= best - 1e-3
        if best > 0.2:
            assert out[i].score == pytest.approx(best / sum(share), abs=0.02)
    held = [out[i].lang_pred == name for i, _, name in rows[:-3] if i % 4 == 2]
    assert sum(held) > 0.95 * len(held)
    assert [out[i].lang_pred for i in (5000, 5001, 5002)] == ["und"] * 3


def test_counts_are_sent_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(language, "COUNTED", 50)
    rng = random.Random(9)
    texts = [tongue(rng, "abcdefg", 30) for _ in range(20)]
    parts = list(language._count(iter([pa.RecordBatch.from_arrays(
        [pa.array(["xx", "yy"] * 10), pa.array(texts)], names=["lang", "text"])] * 3), ["xx", "yy"]))
    assert len(parts) > 2
    counted = Counter()
    for part in parts:
        for gram, lang, seen in zip(*[c.to_pylist() for c in part.columns]):
            counted[gram, lang] += seen
    wanted = Counter((int.from_bytes(g, "big"), i % 2) for i, t in enumerate(texts) for g in plain_grams(t))
    assert counted == Counter({k: 3 * n for k, n in wanted.items()})


def test_chain_is_the_sum_over_distinct_words_then_probabilities(spark, tables, rows):
    docs, labels = tables
    model = toxicity.train(docs, labels)
    assert model.chain_weights.any()
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for i, text, _, _ in rows[::9]:
        words = sorted({w.lower() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[A-Z]+", text)})
        lists = [list(b) for b in next(iter(toxicity.word_buckets(iter([pa.RecordBatch.from_arrays(
            [pa.array([0]), pa.array([" ".join(words)])], names=["k", "text"])]), 1))).column(1).to_pylist()]
        held, earlier = {int(model.slots[b]) for b in lists[0] if model.slots[b] >= 0}, []
        for j, name in enumerate(model.names):
            odds = model.intercepts[j] + sum(model.word_weights[j, s] for s in held)
            odds += sum(model.chain_weights[j, k] * p for k, p in enumerate(earlier))
            earlier.append(1 / (1 + math.exp(-odds)))
            assert getattr(out[i], f"p_{name}") == pytest.approx(earlier[j], abs=1e-5)
