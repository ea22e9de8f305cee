from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from basketlens.llm import decontam

ASCII_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def plain(docs, items):
    out = []
    for doc_id, text in docs:
        own, hit, named = words(text), set(), set()
        for item_id, passage in items:
            w = words(passage)
            n = min(13, len(w))
            windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
            for i in range(len(own) - n + 1):
                if windows and tuple(own[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    if item_id is not None:
                        named.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(named), digest,
                    bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


def run(spark, docs, items):
    frame = decontam.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame(items, "item_id long, text string")).drop("items")
    return sorted(map(tuple, frame.collect()), key=str)


def test_hits_equal_every_window(spark, sentence):
    rng = random.Random(8)
    items = [(i, sentence(rng, n)) for i, n in enumerate((1, 3, 6, 7, 12, 13, 14, 30, 60, 60))]
    items += [(20, items[7][1]), (21, None), (22, ".."), (None, sentence(rng, 20)),
              (23, "same " * 30)]
    docs = []
    for i in range(120):
        text = sentence(rng, rng.randint(0, 90)).split()
        for _ in range(rng.randint(0, 3)):
            passage = (items[rng.randrange(len(items))][1] or "").split()
            if passage:
                low = rng.randrange(len(passage))
                at = rng.randrange(len(text) + 1)
                text[at:at] = passage[low:low + rng.randint(1, 40)]
        docs.append((i, " ".join(text).upper() if i % 7 == 0 else ", ".join(text)))
    docs += [(200, None), (201, ""), (202, items[8][1]), (202, items[8][1]), (None, items[7][1])]
    assert run(spark, docs, items) == plain(docs, items)


def test_empty_benchmark_and_documents(spark):
    assert [r[2] for r in run(spark, [(1, "a b c"), (2, None)], [])] == [0, 0]
    assert run(spark, [], [(1, "a b")]) == []


def test_contaminated_rows_go_by_their_own_text(spark, sentence):
    passage = sentence(random.Random(2), 30)
    docs = spark.createDataFrame([(1, passage, "x"), (1, "clean words", "y"), (None, passage, "z"),
                                  (None, "other", "w")], "doc_id long, text string, hash string")
    items = spark.createDataFrame([(5, passage)], "item_id long, text string")
    kept = decontam.without_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.hash for r in kept.collect()) == ["w", "y"]


def test_every_window_holds_its_fingerprint():
    rng = np.random.default_rng(3)
    stream = rng.integers(0, 2**63, 400, dtype=np.uint64)
    _, at = decontam.fingerprints(stream, np.array([0, 150, 155, 400]))
    for low, high in ((0, 150), (155, 400)):
        for i in range(low, high - 12):
            assert ((at >= i) & (at <= i + 6)).any()
