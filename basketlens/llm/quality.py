"""Quality by Bradley-Terry pairwise ranking.

A text's features are shares that need no dictionary: of letters, capitals, digits, signs,
white space and single signs, of repeated words, of words with signs inside or behind, word
and line lengths.  Preference pairs (a row of label 1 before one of label 0) give feature
differences; logistic loss on them, without an intercept, fits a weight per feature, and a
weighted sum is a text's strength.  The strength at the quantile of the label 0 share is the
threshold; scores are a logistic curve through 0.5 there.

Every labelled row is learned from.  Features are taken where texts are read and dealt by the
hash of the id to blocks of some ``BLOCK_ROWS`` rows; in its block each row of the rarer label
meets ``PAIRS_PER_ROW`` rows of the other, and each of the other at least one.  Where the rarer
label has less than ``FEWEST`` rows for every block, its rows are copied to several blocks.  Scale,
Newton sums, the quantile and the steepness are sums or ranks over the whole table, one row
of sums per task and step reaches the driver.  Every whole text is scored where it is read, without a shuffle.

Defined results: null and empty texts have all-zero features; rows with a null label are
not learned from; repeated labels of an id count with the highest; without both labels all
scores are the share of label 1 (0.5 without any); repeated rows give a row each; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.store import one_text_each, stored
from basketlens.llm.words import VISIBLE, slices, word_hashes
from basketlens.operators.ordering import interpolated_quantiles

PAIRS_PER_ROW = 40
BLOCK_ROWS = 2_048
FEWEST = 64
#: Rows of a file of features: about 30 MB, which no reader splits.
FILE_ROWS = 200_000
RIDGE = 1e-3
SEED = 5

_every = np.arange(256)
_CLASSES = {
    "lower": ((_every >= 97) & (_every <= 122)) | (_every >= 128),
    "upper": (_every >= 65) & (_every <= 90),
    "digit": (_every >= 48) & (_every <= 57),
    "space": _every == 32,
    "line": _every == 10,
    "stop": (_every == 46) | (_every == 44),
    "bar": _every == 124,
    "exclamation": _every == 33,
    "sign": np.isin(_every, [ord(c) for c in "#$%&*@^~_=+<>/\\{}[]"]),
}
_CODE = np.full(256, len(_CLASSES), np.uint8)
for _i, _held in enumerate(_CLASSES.values()):
    _CODE[_held] = _i
FEATURES = (*_CLASSES, "other", "log_words", "word_length", "repeated", "same_as_before",
            "ends_in_sign", "line_words")
N_BASE = len(FEATURES)


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of features per text, all zero where there is no word."""
    rows = len(bounds) - 1
    kinds = len(_CLASSES) + 1
    codes = _CODE[data]
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(rows), sizes)
    shares = (np.bincount(owner * kinds + codes, minlength=rows * kinds).reshape(rows, kinds)
              / np.maximum(sizes, 1)[:, None])
    words, starts, ends, at = word_hashes(data, bounds, VISIBLE)
    count = np.diff(at)
    row = np.repeat(np.arange(rows), count)
    length = np.bincount(row, weights=ends - starts, minlength=rows) / np.maximum(count, 1)
    order = np.lexsort((words, row))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.bincount(row[order][fresh], minlength=rows)
    repeats = 1 - distinct / np.maximum(count, 1)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    signed = codes[ends - 1] >= 6 if len(words) else np.zeros(0, bool)
    mean = lambda flags: np.bincount(row, weights=flags, minlength=rows) / np.maximum(count, 1)
    lines = np.bincount(owner[data == 10], minlength=rows) + 1
    found = np.column_stack([shares, np.log1p(count), np.log1p(length), repeats / np.log(np.e + count),
                             mean(same), mean(signed), np.log1p(count / lines)])
    found[count == 0] = 0
    return found


def widened(x: np.ndarray) -> np.ndarray:
    """Features with their squares and square roots, so that a middle can be preferred."""
    return np.column_stack([x, x ** 2, np.sqrt(np.maximum(x, 0))])


@dataclass(frozen=True)
class Ranking:
    """Scale and weight per widened feature, threshold and steepness of the score."""

    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    steepness: float


def _curve(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sums_of_pairs(differences: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss of preferred-minus-other rows, summed."""
    p = _curve(differences @ weights)
    return differences.T @ (1 - p), (differences * (p * (1 - p))[:, None]).T @ differences


def _newton(sums: Callable[[np.ndarray], tuple[int, np.ndarray, np.ndarray]], inputs: int, ridge: float,
            steps: int) -> np.ndarray:
    """Weights by Newton steps; ``sums`` gives the pairs' number, gradient and curvature."""
    weights = np.zeros(inputs)
    for _ in range(steps):
        pairs, gradient, curve = sums(weights)
        penalty = ridge * pairs
        step = np.linalg.solve(curve + (penalty + 1e-9) * np.eye(inputs), gradient - penalty * weights)
        weights += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-5:
            break
    return weights


def fit_pairs(differences: np.ndarray, ridge: float = RIDGE, steps: int = 15) -> np.ndarray:
    """Bradley-Terry weights: Newton steps on logistic loss of preferred-minus-other rows."""
    return _newton(lambda weights: (len(differences), *_sums_of_pairs(differences, weights)),
                   differences.shape[1], ridge, steps)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features in place of the text, which is the last column."""
    for batch in batches:
        for first, last, data, bounds in slices(batch.column(batch.num_columns - 1)):
            found = features(data, bounds)
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(first, last - first) for c in batch.columns[:-1]),
                 pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), N_BASE)
                 .cast(pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "x"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return widened(batch.column("x").flatten().to_numpy().reshape(-1, N_BASE))


def _dealt(measured: DataFrame) -> tuple[DataFrame, int, int]:
    """The rows (doc_id, quality, x) written in blocks, and the rows of label 0 and label 1.

    A block lies whole in a file, ordered by id; ``first`` marks one copy of each row.
    """
    kept = stored(measured)
    counts = kept.agg(F.count_if(F.col("quality") == 0), F.count_if(F.col("quality") == 1)).first()
    rows, fewer = sum(counts), min(counts)
    blocks = max(1, rows // BLOCK_ROWS)
    copies = min(blocks, -(-FEWEST * blocks // max(fewer, 1)))
    rarer = F.col("quality") == int(counts[1] < counts[0])
    copied = kept.withColumn("copy", F.explode(F.when(
        rarer, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))))
    block = F.pmod(F.xxhash64("doc_id") + F.col("copy") * (blocks // max(copies, 1)), F.lit(blocks))
    dealt = copied.select("doc_id", "quality", "x", block.alias("block"), (F.col("copy") == 0).alias("first"))
    return stored(dealt.repartition(-(-max(rows, 1) // FILE_ROWS), "block")
                  .sortWithinPartitions("block", "doc_id")), counts[0], counts[1]


def _column_sums(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of the widened features' deviations from ``centre`` and of their squares."""
    total = np.zeros((2, len(centre)))
    for batch in batches:
        x = _matrix(batch) - centre
        total += [x.sum(axis=0), (x ** 2).sum(axis=0)]
    yield pa.RecordBatch.from_pydict({"sums": [total.ravel()]})


def _spread(rows: DataFrame, count: int) -> np.ndarray:
    """Standard deviation of each widened feature over all rows: the means first, then squares."""
    centre = np.zeros(3 * N_BASE)
    for _ in range(2):
        parts = rows.select("x").mapInArrow(lambda batches, c=centre: _column_sums(batches, c),
                                            "sums array<double>").toArrow()
        first, second = parts.column("sums").combine_chunks().flatten().to_numpy().reshape(
            -1, 2, len(centre)).sum(axis=0) / count
        centre = centre + first
    return np.sqrt(np.maximum(second - first ** 2, 0))


def _pairs_of(x: np.ndarray, quality: np.ndarray, block: int) -> np.ndarray:
    """Differences of the pairs of one block."""
    good, bad = np.flatnonzero(quality == 1), np.flatnonzero(quality == 0)
    fewer, other = (bad, good) if len(bad) < len(good) else (good, bad)
    if not len(fewer):
        return x[:0]
    rng = np.random.default_rng((SEED, block))
    pairs = max(PAIRS_PER_ROW * len(fewer), len(other))
    one = np.resize(rng.permutation(fewer), pairs)
    two = rng.permutation(np.resize(rng.permutation(other), pairs))
    return x[two] - x[one] if fewer is bad else x[one] - x[two]


def _block_sums(batches: Iterator[pa.RecordBatch], scale: np.ndarray, weights: np.ndarray
                ) -> Iterator[pa.RecordBatch]:
    """Pairs, gradient and curvature, summed over the blocks of a task."""
    inputs, pairs = len(weights), 0
    gradient, curve = np.zeros(inputs), np.zeros((inputs, inputs))

    def add(rows: pa.RecordBatch) -> None:
        nonlocal pairs, gradient, curve
        differences = _pairs_of(_matrix(rows) / scale, rows.column("quality").to_numpy(),
                                rows.column("block")[0].as_py())
        one, two = _sums_of_pairs(differences, weights)
        pairs, gradient, curve = pairs + len(differences), gradient + one, curve + two

    held: list[pa.RecordBatch] = []
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and held[-1].column("block")[0].as_py() != blocks[start]:
                add(pa.concat_batches(held))
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        add(pa.concat_batches(held))
    yield pa.RecordBatch.from_pydict({"pairs": [pairs], "sums": [np.concatenate([gradient, curve.ravel()])]})


def _strengths(batches: Iterator[pa.RecordBatch], scale: np.ndarray, weights: np.ndarray
               ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("quality"), pa.array((_matrix(batch) / scale) @ weights)], names=["quality", "strength"])


def fit_ranking(measured: DataFrame) -> Ranking:
    """Fit on all rows of ``measured`` (doc_id, quality, x)."""
    dealt, bad, good = _dealt(measured)
    if not good or not bad:
        share = good / (good + bad) if good + bad else 0.5
        odds = np.clip(np.log(max(share, 1e-6) / max(1 - share, 1e-6)), -10, 10)
        return Ranking(np.ones(3 * N_BASE), np.zeros(3 * N_BASE), -float(odds), 1.0)
    each = dealt.where("first")
    scale = np.maximum(_spread(each, good + bad), 1e-6)
    inputs = len(scale)

    def sums(weights: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        parts = dealt.select("block", "quality", "x").mapInArrow(
            lambda batches: _block_sums(batches, scale, weights), "pairs long, sums array<double>").toArrow()
        total = parts.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, inputs + inputs ** 2).sum(axis=0)
        return sum(parts.column("pairs").to_pylist()), total[:inputs], total[inputs:].reshape(inputs, inputs)

    weights = _newton(sums, inputs, RIDGE, 15)
    strengths = stored(each.select("quality", "x").mapInArrow(
        lambda batches: _strengths(batches, scale, weights), "quality int, strength double"))
    threshold, = interpolated_quantiles(strengths, "strength", [(0, good + bad, bad / (good + bad))], good + bad)
    # The steepness alone is fitted; 0.5 stays at the quantile.
    centred, steepness = F.col("strength") - F.lit(threshold), 1.0
    for _ in range(30):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), centred * F.lit(steepness)))))
        slope, curve = strengths.agg(F.sum(centred * (F.col("quality") - p)),
                                     F.sum(centred * centred * p * (1 - p))).first()
        before = steepness
        steepness = float(np.clip(steepness + np.clip(slope / max(curve, 1e-9), -0.5, 0.5), 1e-3, 50))
        if abs(steepness - before) < 1e-9:
            break
    return Ranking(scale, weights, threshold, steepness)


def _marks(labels: DataFrame) -> DataFrame:
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
            .agg(F.max("quality").cast("int").alias("quality")))


def train(labelled: DataFrame) -> Ranking:
    """Fit on all rows of ``labelled`` (doc_id, quality, text), as ``sample_of`` gives them."""
    return fit_ranking(labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"),
        F.col("text").cast("string").alias("text"))
        .mapInArrow(_measure, "doc_id long, quality int, x array<double>"))


def learn(documents: DataFrame, labels: DataFrame) -> Ranking:
    """Fit on all labelled documents; features meet the labels, so texts are not shuffled."""
    measured = documents.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"),
        F.col("text").cast("string").alias("text")).mapInArrow(
        _measure, "doc_id long, hash long, x array<double>")
    marks = _marks(labels).select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    return fit_ranking(measured.join(marks, "doc_id").groupBy("doc_id", "quality").agg(
        F.min(F.struct("hash", "x")).alias("least")).select("doc_id", "quality", F.col("least.x").alias("x")))


def sample_of(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """All labelled documents (doc_id, quality, text), one text of each id."""
    marks = _marks(labels)
    held = documents.select("doc_id", "text").join(marks.select("doc_id"), "doc_id", "left_semi")
    return one_text_each(held).join(marks, "doc_id").select("doc_id", "quality", "text")


def _rate(batches: Iterator[pa.RecordBatch], model: Ranking) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, bounds in slices(batch.column(2)):
            strength = (widened(features(data, bounds)) / model.scale) @ model.weights
            score = _curve(model.steepness * (strength - model.threshold))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                 pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])


def rate(documents: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, held_out, score and predicted; ``documents`` has doc_id, held_out and text."""
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out",
                             F.col("text").cast("string").alias("text"))
            .mapInArrow(lambda batches: _rate(batches, model),
                        "doc_id long, held_out boolean, score double, predicted int"))
