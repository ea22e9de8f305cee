from __future__ import annotations

import random

import pytest

LETTERS = "aeioulnrst"


@pytest.fixture(scope="session")
def sentence():
    """Seeded prose: ``sentence(rng, n)`` gives n invented words."""
    def make(rng: random.Random, count: int) -> str:
        return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 7)))
                        for _ in range(count))
    return make


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text) rows, with further columns if given."""
    def make(rows, extra=""):
        return spark.createDataFrame(rows, "doc_id long, text string" + extra)
    return make
