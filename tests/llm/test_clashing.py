"""Columns of a table may have any names, also those that the operators use inside."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketlens.llm import decontam, mixing, near, private, toxicity
from basketlens.llm.store import bounded_batches, free_name

NAMES = ("node", "kept_node", "bad_key", "mixed_id", "mix_repeats", "mix_copy", "component", "key",
         "salt", "words", "p_toxic", "spans")


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(1, "one two three four five six seven", "a"), (2, "one two three four five six seven", "a"),
            (3, "write to a.b@mail.example.com", "b"), (None, None, None)]
    held = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return held.withColumns({name: F.lit("kept as it is") for name in NAMES})


def test_stages_keep_clashing_columns(spark, clashing):
    items = spark.createDataFrame([(1, "write to a.b")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long")
    cases = {
        "near": (near.one_of_each(clashing), [None, 1, 3]),
        "decontam": (decontam.without_contaminated(clashing, items), [None, 1, 2]),
        "private": (private.redacted(clashing, None), [None, 1, 2, 3]),
        "toxicity": (toxicity.without_toxic(clashing, toxicity.train(clashing, labels)),
                     [None, 1, 2, 3])}
    for name, (kept, ids) in cases.items():
        assert kept.columns == clashing.columns, name
        found = kept.collect()
        assert sorted((row.doc_id for row in found), key=str) == sorted(ids, key=str), name
        assert {row[c] for row in found for c in NAMES} == {"kept as it is"}, name
    written = mixing.write_out(clashing, labels).collect()
    assert written and {row.mixed_id for row in written} == {"kept as it is"}


def test_empty_tables(spark, clashing):
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    none = clashing.limit(0)
    assert near.one_of_each(none).count() == 0
    assert decontam.without_contaminated(none, items).count() == 0
    assert private.redacted(none, private.train(none)).count() == 0
    assert toxicity.without_toxic(none, toxicity.train(none, labels)).count() == 0
    assert mixing.write_out(none, labels).count() == 0


def test_free_names_and_batches(spark):
    frame = spark.createDataFrame([], "a long, A_ long, b long")
    assert (free_name(frame, "a"), free_name(frame, "c")) == ("a__", "c")
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(bound, None)
    try:
        spark.conf.set(bound, "12345")
        assert bounded_batches(spark).conf.get(bound) == "12345"
    finally:
        spark.conf.unset(bound) if before is None else spark.conf.set(bound, before)
