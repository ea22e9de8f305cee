from __future__ import annotations

import random

import pytest

import __spark_entry__
import corpus_pipeline
from basketlens.llm import decontam, mixing, near, private, toxicity
from basketlens.llm.oracle import ORACLE
from basketlens.llm.queries import REGISTRY


@pytest.fixture(scope="module")
def folder(spark, sentence, tmp_path_factory):
    rng, path = random.Random(11), tmp_path_factory.mktemp("corpus")
    texts = [sentence(rng, rng.randint(20, 80)) for _ in range(200)]
    for i in range(0, 200, 8):
        texts[i] += " you fool, vile fool"
    texts[3] = texts[1] + " and a little more"
    texts[5] = texts[1]
    passage = sentence(rng, 25)
    texts[9] = f"{texts[9][:200]} {passage}"
    texts[11] += " write to some.one@mail.example.com"
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)] + [(300, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(120)],
                          "doc_id long, quality long, toxic long").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_each_stage_decides_and_keeps_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        docs = corpus_pipeline.stored(kept)
    found = {r.doc_id: r for r in docs.collect()}
    gone = {*range(0, 200, 8), 3, 5, 9}
    assert set(found) == set(range(200)) - gone | {300}
    assert found[11].text.endswith("write to [EMAIL]") and found[11].n_chars == len(found[11].text)
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in mixed.collect()} == set(found)
    run = sorted(map(str, corpus_pipeline.run(spark, folder).collect()))
    assert run == sorted(map(str, mixed.collect()))


def test_stages_are_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "decontamination", "personal_data", "mixing"]
    assert all((toxicity, near, decontam, private, mixing))


def test_registered_queries_and_statements():
    names = set(__spark_entry__.queries())
    assert {*REGISTRY, "pipeline"} <= names and set(ORACLE) <= set(REGISTRY)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
