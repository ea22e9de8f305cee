from __future__ import annotations

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest

from basketlens.llm import queries, runs


def brute_runs(words):
    """(start, length, period) of all runs, by scanning every period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def planted(rng, letters, count):
    words = [rng.choice(letters) for _ in range(count)]
    if count > 4 and rng.random() < 0.6:
        a = rng.randrange(count)
        p = 1 + (count - a) // rng.randint(3, 10)
        words = [words[i if i < a else a + (i - a) % p] for i in range(count)]
    return words


@pytest.mark.parametrize("at_once", [3, 70, 1 << 20])
def test_runs_of_many_texts_at_once(monkeypatch, at_once):
    monkeypatch.setattr(runs, "CANDIDATES_AT_ONCE", at_once)
    rng = random.Random(at_once)
    for _ in range(120):
        texts = [planted(rng, range(rng.choice([1, 2, 3, 9])), rng.choice([0, 1, 5, 6, 7, 24, 90]))
                 for _ in range(rng.randint(1, 9))]
        bounds = np.append(0, np.cumsum([len(text) for text in texts]))
        found = runs.find_runs(np.array([w for text in texts for w in text], np.int64), bounds)
        expected = [(bounds[i] + s, bounds[i] + s + length, q)
                    for i, text in enumerate(texts) for s, length, q in brute_runs(text)]
        assert list(zip(*found)) == expected


def test_the_grammar_extends_exactly():
    rng = np.random.default_rng(4)
    for letters in (1, 2, 5):
        symbols = np.concatenate([rng.integers(0, letters, 400), [letters]])
        rounds = runs.recompress(symbols)
        assert len(rounds[-1].first) == 2
        a, b = rng.integers(0, 400, (2, 500))
        a, b = a[a != b], b[a != b]
        agreed = []
        for i, j in zip(a, b):
            n = 0
            while max(i, j) + n < len(symbols) and symbols[i + n] == symbols[j + n]:
                n += 1
            agreed.append(n)
        assert runs.common_extensions(rounds, a, b).tolist() == agreed


def test_rows_of_all_kinds(spark, documents):
    text = "x " + "a\tb\n" * 5 + "end"
    rows = [(1, None), (2, ""), (3, " \n"), (4, text), (4, text), (None, text),
            (5, " é é é é é é"), (6, "one two three")]
    held = spark.createDataFrame([(*row, "?", 7) for row in rows],
                                 "doc_id long, text string, runs string, n_words int")
    found = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                    for r in runs.periodic_runs(held).collect()), key=str)
    abab = (12, [(1, 10, 2)], "x a b end")
    assert found == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, *abab), (4, *abab), (None, *abab),
        (5, 6, [], " é é é é é é"), (6, 3, [], "one two three")], key=str)
    assert runs.periodic_runs(documents([])).count() == 0


def test_a_very_long_text(documents, monkeypatch):
    monkeypatch.setattr(runs, "BYTES_AT_ONCE", 1000)
    rng = random.Random(1)
    head = [str(rng.random()) for _ in range(30_000)]
    row = runs.periodic_runs(documents([(1, " ".join(head + ["p", "q", "r"] * 20_000))])).first()
    assert [tuple(run) for run in row.runs] == [(30_000, 60_000, 3)]
    assert row.collapsed == " ".join(head + ["p", "q", "r"])


def expected_row(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, code = len(words), zlib.crc32(str(doc_id).encode())
    g = code // 10
    if code % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    best = min(found, key=lambda run: (-run[1], run[0], run[2])) if found else (None,) * 3
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
            sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def test_the_query_against_brute_force(spark, tmp_path, sentence):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, "", "lone", sentence(rng, 5), sentence(rng, rng.randint(6, 120)),
                            " ".join(planted(rng, ["aa", "b", "ccc"], 60))])) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                             "runs_sha256", "collapsed_sha256"]
    result = {row.doc_id: tuple(row) for row in found.collect()}
    assert [result[i] for i, _ in rows] == [expected_row(*row) for row in rows]
    assert sum(row[1] > 0 for row in result.values()) > 30
