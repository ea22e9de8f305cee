from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from basketlens.llm import mixing


def plain_targets(sizes):
    """Share by weight, cap, and reshare the excess round by round."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(sizes), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        open_ -= over
    return target


def plain_mix(rows, quality):
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    totals = {}
    for (_, _, s), n in zip(rows, sizes):
        totals[s] = totals.get(s, 0) + n
    target, out = plain_targets(totals), []
    for source in totals:
        own = []
        for (i, _, s), n in zip(rows, sizes):
            if s == source:
                u = (int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:13], 16) + .5) / 2 ** 52
                own.append((-math.log(u) / {1: 2.0, 0: 0.5}.get(quality.get(i), 1.0),
                            -1 if i is None else i, n, i))
        epochs = int(target[source] // totals[source]) if totals[source] else 0
        rest, upto = target[source] - epochs * totals[source], 0
        for _, _, n, i in sorted(own, key=lambda x: x[:3]):
            upto += n
            extra = n > 0 and upto - n < rest and upto - n / 2 <= rest
            out.append((i, n, totals[source], target[source], n * min(3, epochs + extra)))
    return out


@pytest.fixture(scope="module")
def rows(sentence):
    rng = random.Random(1)
    sources = ["b", "a", "é", "Z", None, "big", "tiny"]
    rows = [(i, sentence(rng, rng.randint(0, 40)), rng.choice(sources[:6])) for i in range(400)]
    rows += [(i, sentence(rng, 9), "big") for i in range(400, 900)]
    return rows + [(900, "one", "tiny"), (901, None, "tiny"), (902, "", "empty"), (None, "a b", None)]


def as_tuples(frame):
    return [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in frame.collect()]


def run(spark, rows, quality):
    docs = spark.createDataFrame([(*r, "x") for r in rows],
                                 "doc_id long, text string, source string, weight string")
    labels = spark.createDataFrame(list(quality.items()), "doc_id long, quality int")
    return as_tuples(mixing.mix(docs, labels))


def test_mix_equals_the_plain_one(spark, rows):
    quality = {i: i % 2 for i in range(0, 900, 3)}
    found, expected = run(spark, rows, quality), plain_mix(rows, quality)
    key = lambda r: (r[0] is None, r[0] or 0)
    for one, two in zip(sorted(found, key=key), sorted(expected, key=key), strict=True):
        assert one[:3] == two[:3] and one[4] == two[4] and one[3] == pytest.approx(two[3])
    assert found and sorted(run(spark, rows, quality), key=key) == sorted(found, key=key)


def test_sources_come_near_their_targets(spark, rows):
    taken, target, most = {}, {}, {}
    source = {r[0]: r[2] for r in rows}
    for i, n, _, t, words in run(spark, rows, {}):
        s = source[i]
        taken[s], target[s] = taken.get(s, 0) + words, t
        most[s] = max(most.get(s, 0), n)
        assert words <= 3 * n
    assert all(abs(taken[s] - target[s]) <= most[s] for s in target)


def test_few_bins_and_ties_give_the_same(spark, rows, monkeypatch):
    usual = sorted(map(str, run(spark, rows, {})))
    monkeypatch.setattr(mixing, "BINS", 4)
    assert sorted(map(str, run(spark, rows, {}))) == usual


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, "a b c", "s" if i % 2 else "t") for i in range(3000)]
    taken = {i: w for i, _, _, _, w in run(spark, rows, {i: int(i % 4 < 2) for i in range(3000)})}
    share = lambda good: sum(taken[i] for i in range(0, 3000, 2) if (i % 4 < 2) == good)
    assert share(True) > 1.2 * share(False)


def test_empty_and_wordless_tables(spark):
    assert run(spark, [], {}) == []
    assert sorted(run(spark, [(1, "", "a"), (2, None, None)], {1: 1})) == [
        (1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_written_mix_repeats_documents(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, "d " * 100, "y")],
                                 "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    counts = {r.doc_id: r["count"] for r in mixing.write_out(docs, labels).groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.repeats for r in mixing.mix(docs, labels).collect() if r.repeats}
