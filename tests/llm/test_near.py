from __future__ import annotations

import random
import re

import pytest

from basketlens.llm import near
from basketlens.llm.components import components

ASCII_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def plain_shingles(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def plain_classes(rows, similarity):
    """All pairs: links and least doc_id of each connected class, by row."""
    sets, links = [plain_shingles(t) for _, t in rows], [0] * len(rows)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / len(sets[i] | sets[j]) >= similarity:
                links[i] += 1
                links[j] += 1
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {x: min(rows[k][0] for k in range(len(rows)) if label[k] == x) for x in set(label)}
    return sorted((rows[k][0], least[label[k]], links[k]) for k in range(len(rows)))


@pytest.fixture(scope="module")
def rows(sentence):
    rng = random.Random(4)
    texts = [sentence(rng, rng.randint(1, 120)) for _ in range(60)]
    for base in (0, 7, 12):  # chains of ever further copies
        text = sentence(rng, 80).split()
        for _ in range(12):
            text[rng.randrange(80)] = "changed"
            texts.append(" ".join(text))
    texts += [texts[0]] * 5 + [texts[3].upper(), "one two", "One, two!", "", "", None, " .,; "]
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


def found(frame):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in frame.collect())


def test_classes_and_links_equal_all_pairs(documents, rows):
    assert found(near.near_classes(documents(rows))) == plain_classes(rows, 0.8)


def test_blocks_of_large_groups_give_the_same(documents, rows, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_ROWS", 4)
    assert found(near.near_classes(documents(rows))) == plain_classes(rows, 0.8)


def test_repeated_rows_nulls_and_further_columns(documents):
    frame = documents([(1, "a b c d e f", "x"), (1, "a b c d e f", "y"), (None, "a b c d e f", "z"),
                       (4, None, None)], ", node string")
    assert sorted((r.doc_id or 0, r.class_id, r.n_links) for r in near.near_classes(frame).collect()) == [
        (0, 1, 2), (1, 1, 2), (1, 1, 2), (4, 4, 0)]


def test_empty_table(documents):
    assert near.near_classes(documents([])).collect() == []


def test_one_of_each_keeps_the_least_id_and_all_columns(documents, rows):
    frame = documents([(i, t, "s") for i, t in rows], ", source string")
    kept = near.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        {c for _, c, _ in plain_classes(rows, 0.8)})


def test_one_of_each_decides_by_row(documents):
    text = " ".join(f"word{i}" for i in range(80))
    near_text, other = text + " more", " ".join(f"other{i}" for i in range(80))
    frame = documents([(None, text), (None, text), (None, near_text),  # copies without ids
                       (None, "alone one two three four five"),
                       (5, other), (5, other + " x"), (5, "x y z u v w"),  # one id under several texts
                       (1, "a b c d e f g"), (7, "a b c d e f g"), (7, "s t u v w x y")])
    kept = [(r.doc_id, r.text) for r in near.one_of_each(frame).collect()]
    assert sum(i is None and t.startswith("word0") for i, t in kept) == 1
    assert sum(t.startswith("other0") for _, t in kept) == 1
    assert sorted(x for x in kept if len(x[1]) < 20) == [
        (1, "a b c d e f g"), (5, "x y z u v w"), (7, "s t u v w x y")]
    assert len(kept) == 6  # with the lone text


def test_a_near_copy_goes_though_its_id_stays_for_another_text(documents):
    text = " ".join(f"word{i}" for i in range(80))
    frame = documents([(1, text), (5, text + " more"), (5, "x y z u v w")])
    assert sorted((r.doc_id, r.text) for r in near.one_of_each(frame).collect()) == [
        (1, text), (5, "x y z u v w")]


def test_prefix_shortens_until_the_recall_is_met():
    assert near.prefix_length(32, 8, 0.8, 0.9999) == 6
    assert near.prefix_length(32, 8, 0.8, 0.5) == 8
    assert near.prefix_length(1, 8, 0.8, 1.1) == 1


def test_components_of_chains_and_stars(spark):
    chain = [(f"a{i:03}", f"a{i + 1:03}") for i in range(40)]
    star = [("hub", f"z{i}") for i in range(30)] + [("hub", "hub")]
    out = {r.node: r.component for r in components(
        spark.createDataFrame(chain + star, "one string, two string")).collect()}
    assert {n: c for n, c in out.items() if n[0] == "a"} == {f"a{i:03}": "a000" for i in range(41)}
    assert {c for n, c in out.items() if n[0] != "a"} == {"hub"} and len(out) == 41 + 31
