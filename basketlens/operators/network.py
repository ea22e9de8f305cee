"""Fitting the one-layer response network by synchronous data-parallel Adam.

Standardized rows are stored once.  In every step each task sums losses and gradients over
its rows in Arrow batches, the sums meet by parameter with map-side combining, and the
driver, which sees one number per parameter however many rows or tasks there are, moves
the weights.  Partial sums are added as decimals, so that the order in which tasks finish
changes nothing.  One pass gives the training gradient and the validation loss, on which
fitting stops early and the best weights are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketlens.operators.response import FeedForward, Standardizer, class_balance, in_split
from basketlens.sources.session import with_package
from basketlens.sources.sinks import stored

#: Improvements of the validation loss below this count as none.
LEAST_GAIN = 1e-7
#: Sums after the parameters' own: training weight x loss, training loss, validation loss, rows.
TOTALS = ("weighted_loss", "train_loss", "train_rows", "validation_loss", "validation_rows")


@dataclass(frozen=True)
class NetworkFit:
    """The best network, and what fitting saw of it."""

    network: FeedForward
    positive_weight: float | None
    best_step: int
    best_validation_loss: float
    early_stopped: bool
    history: tuple[dict, ...]


@dataclass
class Weights:
    """The parameters as arrays that share one flat vector."""

    flat: np.ndarray
    inputs: int

    @property
    def units(self) -> int:
        return (len(self.flat) - 1) // (self.inputs + 2)

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Hidden weights (unit by input), hidden bias, output weights, output bias."""
        hidden, n = self.units * self.inputs, self.units
        return (self.flat[:hidden].reshape(n, self.inputs), self.flat[hidden:hidden + n],
                self.flat[hidden + n:hidden + 2 * n], float(self.flat[-1]))

    def network(self) -> FeedForward:
        hidden, bias, output, last = self.parts()
        return FeedForward(tuple(map(tuple, hidden.tolist())), tuple(bias.tolist()),
                           tuple(output.tolist()), last)


def initial_weights(inputs: int, units: int, seed: int) -> Weights:
    """Uniform in plus and minus one over the root of each layer's inputs."""
    rng = np.random.default_rng(seed)
    hidden = rng.uniform(-1, 1, units * (inputs + 1)) / np.sqrt(inputs)
    return Weights(np.concatenate([hidden, rng.uniform(-1, 1, units + 1) / np.sqrt(units)]), inputs)


def batch_sums(weights: Weights, x: np.ndarray, y: np.ndarray, train: np.ndarray,
               positive_weight: float) -> np.ndarray:
    """Gradient of the weighted training loss, summed over rows, then ``TOTALS``."""
    hidden, bias, output, last = weights.parts()
    sums = x @ hidden.T + bias
    active = np.maximum(sums, 0.0)
    logit = active @ output + last
    loss = np.logaddexp(0.0, logit) - y * logit
    weight = np.where(y == 1, positive_weight, 1.0) * train
    slope = weight * (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y)
    back = slope[:, None] * output * (sums > 0)
    return np.concatenate([
        (back.T @ x).ravel(), back.sum(0), active.T @ slope, [slope.sum()],
        [(weight * loss).sum(), loss[train].sum(), train.sum(), loss[~train].sum(), (~train).sum()]])


def _task_sums(batches: Iterator[pa.RecordBatch], weights: Weights, positive_weight: float
               ) -> Iterator[pa.RecordBatch]:
    total = np.zeros(len(weights.flat) + len(TOTALS))
    for batch in batches:
        if batch.num_rows:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, weights.inputs)
            total += batch_sums(weights, x, batch.column(1).to_numpy(),
                                batch.column(2).to_numpy(zero_copy_only=False), positive_weight)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)],
                                     names=["place", "value"])


def summed(rows: DataFrame, weights: Weights, positive_weight: float) -> np.ndarray:
    """``batch_sums`` over all rows of (x, y, train); one row per parameter reaches the driver."""
    parts = rows.mapInArrow(lambda batches: _task_sums(batches, weights, positive_weight),
                            "place long, value double")
    found = parts.groupBy("place").agg(
        F.sum(F.col("value").cast("decimal(38,12)")).cast("double").alias("value")).toArrow()
    result = np.zeros(len(weights.flat) + len(TOTALS))
    result[found.column("place").to_numpy()] = found.column("value").to_numpy()
    return result


def fit_network(dataset: DataFrame, standardizer: Standardizer, hidden_units: int = 32,
                weighted: bool = True, learning_rate: float = 0.02, max_steps: int = 100,
                patience: int = 10, seed: int = 20260929) -> NetworkFit:
    """Fit on training rows, stop when validation loss has not improved for ``patience`` steps.

    ``dataset`` holds the features, ``target_redeemed`` and ``data_split``.  With
    ``weighted``, a positive training row counts as often as there are negative ones to a
    positive one; the validation loss is never weighted.
    """
    with_package(dataset.sparkSession)
    balance = class_balance(in_split(dataset, "train")).first()
    positive_weight = float(balance.positive_weight) if weighted else 1.0
    rows = stored(
        dataset.where(F.col("data_split").isin("train", "validation")).select(
            standardizer.vector().alias("x"), F.col("target_redeemed").cast("double").alias("y"),
            (F.col("data_split") == "train").alias("train")), f"network-{uuid4().hex}")
    if rows.where("NOT train").isEmpty():
        raise ValueError("early stopping needs validation rows")
    weights = initial_weights(len(standardizer.features), hidden_units, seed)
    mean, spread = np.zeros_like(weights.flat), np.zeros_like(weights.flat)
    best, best_loss, best_step, waiting, history = weights.flat.copy(), np.inf, 0, 0, []
    for step in range(max_steps + 1):
        sums = summed(rows, weights, positive_weight)
        gradient, totals = sums[:len(weights.flat)], dict(zip(TOTALS, sums[len(weights.flat):]))
        gradient = gradient / totals["train_rows"]
        loss = totals["validation_loss"] / totals["validation_rows"]
        history.append({"step": step, "training_loss": totals["weighted_loss"] / totals["train_rows"],
                        "training_unweighted_loss": totals["train_loss"] / totals["train_rows"],
                        "validation_loss": loss})
        if loss < best_loss - LEAST_GAIN:
            best, best_loss, best_step, waiting = weights.flat.copy(), loss, step, 0
        else:
            waiting += 1
        if waiting >= patience or step == max_steps:
            break
        mean += 0.1 * (gradient - mean)
        spread += 0.001 * (gradient ** 2 - spread)
        weights.flat = weights.flat - learning_rate * (mean / (1 - 0.9 ** (step + 1))) / (
            np.sqrt(spread / (1 - 0.999 ** (step + 1))) + 1e-8)
    return NetworkFit(Weights(best, weights.inputs).network(), positive_weight if weighted else None,
                      best_step, float(best_loss), waiting >= patience, tuple(history))


def history_frame(fit: NetworkFit, dataset: DataFrame) -> DataFrame:
    """One row per step: losses, and whether its weights were kept."""
    rows: Sequence[tuple] = [(h["step"], float(h["training_loss"]),
                              float(h["training_unweighted_loss"]), float(h["validation_loss"]),
                              h["step"] == fit.best_step) for h in fit.history]
    return dataset.sparkSession.createDataFrame(
        rows, "step long, training_loss double, training_unweighted_loss double, "
              "validation_loss double, kept boolean")
