"""Toxicity by classifier chains over word features.

Categories are predicted one after another.  Each category's linear model sees the words
that tell it apart in the labelled rows and the probabilities that the earlier models of the
chain give.  In training those probabilities are out-of-fold predictions, so that a later model
meets earlier outputs as wrong as they will be on new texts; equal texts share a fold.

The models are fitted on the driver from at most ``SAMPLE_ROWS`` labelled rows (least
hashes of the id, one text of each id).  Every text is then scored where it is read, without a shuffle.

Defined results: null, empty and wordless texts are scored from the intercepts; rows with
a null label are not learned from; repeated labels of an id count with their highest
values; without labelled rows of both classes a category has the share of its class (0
without any) as probability; repeated rows give a row each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.store import hashed_sample, one_text_each
from basketlens.llm.words import ALPHANUMERIC, slices, word_hashes

SAMPLE_ROWS = 16_000
FEATURES = 200
LEAST_DOCUMENTS = 5
BUCKET_BITS = 18
FOLDS = 5
#: By held-out labels of sf0.1: 175 of 226 toxic texts found at 0.5 and none wrongly; 155 at 2.0.
RIDGE, CHAIN_RIDGE = 0.5, 0.05
THRESHOLD = 0.5
#: The chain: category and its label, from the columns of the labels.
CATEGORIES = (("junk", "quality = 0"), ("toxic", "toxic = 1"),
              ("toxic_junk", "toxic = 1 AND quality = 0"))


def word_buckets(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    """Replace the last column, a text, by its distinct word buckets."""
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(keep)):
            words, _, _, bounds = word_hashes(data, offsets, ALPHANUMERIC)
            row = np.repeat(np.arange(last - first), np.diff(bounds)).astype(np.uint64)
            codes = np.unique(row << np.uint64(BUCKET_BITS) | words >> np.uint64(64 - BUCKET_BITS))
            starts = np.searchsorted(codes >> np.uint64(BUCKET_BITS), np.arange(last - first + 1))
            buckets = (codes & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(first, last - first) for i in range(keep)]
                + [pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(buckets))],
                names=[*batch.schema.names[:keep], "buckets"])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray | None = None,
                 ridge: float = RIDGE, steps: int = 10, chained: int = 0) -> np.ndarray:
    """Weights and, last, the intercept of a ridge logistic regression, by Newton steps.

    The last ``chained`` columns are probabilities; they are few and dense, so hardly shrunk.
    """
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    weights = np.zeros(x.shape[1])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    weights[-1] = np.log(share / (1 - share))
    if y.min() == y.max():
        return weights
    if start is not None:
        weights = start.copy()
    penalty = np.full(x.shape[1], ridge)
    penalty[-1 - chained:] = CHAIN_RIDGE
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ weights)
        gradient = x.T @ (p - y) + penalty * weights
        curve = x.T @ (x * (p * (1 - p))[:, None].astype(x.dtype)) + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        weights = weights - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-3:
            break
    return weights


def telling_buckets(rows: np.ndarray, buckets: np.ndarray, y: np.ndarray, count: int) -> np.ndarray:
    """The buckets whose presence departs most from the class share (chi square)."""
    held = np.bincount(buckets, minlength=1 << BUCKET_BITS)
    hits = np.bincount(buckets, weights=y[rows], minlength=1 << BUCKET_BITS)
    share = y.mean()
    if not 0 < share < 1:
        return np.zeros(0, np.int64)
    departure = np.abs(hits - held * share) - 0.5
    score = np.where((held >= LEAST_DOCUMENTS) & (departure > 0),
                     departure ** 2 / np.maximum(held * share * (1 - share), 1e-9), 0)
    best = np.argsort(-score, kind="stable")[:count]
    return np.sort(best[score[best] > 6.6])


@dataclass(frozen=True)
class ChainModel:
    """Per category: its buckets, their weights, weights of earlier probabilities, intercept."""

    names: tuple[str, ...]
    slots: np.ndarray
    word_weights: np.ndarray
    chain_weights: np.ndarray
    intercepts: np.ndarray


def fit_chain(names: Sequence[str], labels: np.ndarray, rows: np.ndarray, buckets: np.ndarray,
              fold: np.ndarray) -> ChainModel:
    """Fit a chain on (rows x categories) labels and the (row, bucket) pairs of the rows."""
    chosen = ([telling_buckets(rows, buckets, labels[:, j], FEATURES) for j in range(len(names))]
              if len(labels) else [np.zeros(0, np.int64)] * len(names))
    every = np.unique(np.concatenate(chosen)).astype(np.int64)
    slots = np.full(1 << BUCKET_BITS, -1, np.int16)
    slots[every] = np.arange(len(every))
    word_weights = np.zeros((len(names), len(every)))
    chain_weights, intercepts = np.zeros((len(names), len(names))), np.full(len(names), -40.0)
    earlier = np.zeros((len(labels), 0), np.float32)
    for j in range(len(names)):
        if not len(labels):
            break
        own = slots[chosen[j]]
        place = np.full(len(every) + 1, -1)
        place[own] = np.arange(len(own))
        at = place[slots[buckets]]
        x = np.zeros((len(labels), len(own) + j), np.float32)
        x[rows[at >= 0], at[at >= 0]] = 1
        x[:, len(own):] = earlier
        y = labels[:, j].astype(np.float64)
        weights = fit_logistic(x, y, chained=j)
        word_weights[j, own] = weights[:len(own)]
        chain_weights[j, :j] = weights[len(own):-1]
        intercepts[j] = weights[-1]
        out = np.zeros(len(labels))
        for k in range(FOLDS):
            held = fold == k
            part = fit_logistic(x[~held], y[~held], weights, chained=j) if (~held).any() else weights
            out[held] = x[held] @ part[:-1] + part[-1]
        earlier = np.column_stack([earlier, sigmoid(out)]).astype(np.float32)
    return ChainModel(tuple(names), slots, word_weights, chain_weights, intercepts)


def train(documents: DataFrame, labels: DataFrame,
          categories: Sequence[tuple[str, str]] = CATEGORIES,
          sample_rows: int = SAMPLE_ROWS) -> ChainModel:
    """Fit the chain on a bounded sample of the labelled documents."""
    marks = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND quality IS NOT NULL")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality")))
    marks = hashed_sample(marks, sample_rows)
    names = [name for name, _ in categories]
    sample = (documents.select("doc_id", F.col("text").cast("string").alias("text"))
              .join(F.broadcast(marks.select("doc_id")), "doc_id"))  # at most sample_rows numbers
    sample = (one_text_each(sample).join(F.broadcast(marks), "doc_id")
              .select(F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"),
                      *[F.expr(rule).cast("int").alias(name) for name, rule in categories], "text"))
    keep = len(names) + 1
    found = sample.mapInArrow(
        lambda batches: word_buckets(batches, keep),
        "fold int, " + ", ".join(f"{n} int" for n in names) + ", buckets array<int>").toArrow()
    lists = found.column("buckets").combine_chunks()
    y = np.column_stack([found.column(n).to_numpy() for n in names]).astype(np.int64)
    counts = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    return fit_chain(names, y, np.repeat(np.arange(len(y)), counts), lists.flatten().to_numpy(),
                     found.column("fold").to_numpy())


def _apply(batches: Iterator[pa.RecordBatch], model: ChainModel) -> Iterator[pa.RecordBatch]:
    features = max(model.word_weights.shape[1], 1)
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(1)):
            words, _, _, bounds = word_hashes(data, offsets, ALPHANUMERIC)
            slot = model.slots[words >> np.uint64(64 - BUCKET_BITS)]
            held = np.flatnonzero(slot >= 0)
            row = np.searchsorted(bounds, held, side="right") - 1
            pairs = np.unique(row * features + slot[held])
            row, slot = pairs // features, pairs % features
            p = np.zeros((last - first, len(model.names)))
            for j in range(len(model.names)):
                words_part = (np.bincount(row, weights=model.word_weights[j, slot],
                                          minlength=last - first) if len(row) else 0)
                p[:, j] = sigmoid(words_part + p[:, :j] @ model.chain_weights[j, :j]
                                  + model.intercepts[j])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first)]
                + [pa.array(p[:, j]) for j in range(len(model.names))],
                names=["doc_id", *[f"p_{n}" for n in model.names]])


def score(documents: DataFrame, model: ChainModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, one probability p_<category> per category, and toxic (boolean)."""
    columns = ", ".join(f"p_{n} double" for n in model.names)
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                             F.col("text").cast("string").alias("text"))
            .mapInArrow(lambda batches: _apply(batches, model), f"doc_id long, {columns}")
            .withColumn("toxic", F.col("p_toxic") >= threshold))


def _clean(batches: Iterator[pa.RecordBatch], model: ChainModel, id_at: int, text_at: int,
           threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pair = pa.RecordBatch.from_arrays([batch.column(id_at), batch.column(text_at)],
                                          names=["doc_id", "text"])
        done = 0
        for scored in _apply(iter([pair]), model):  # a slice at a time, not the batch again
            part = batch.slice(done, scored.num_rows)
            done += scored.num_rows
            yield part.filter(pa.array(scored.column("p_toxic").to_numpy() < threshold))


def without_toxic(documents: DataFrame, model: ChainModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose toxicity is below the threshold."""
    id_at, text_at = documents.columns.index("doc_id"), documents.columns.index("text")
    return documents.mapInArrow(
        lambda batches: _clean(batches, model, id_at, text_at, threshold), documents.schema)
