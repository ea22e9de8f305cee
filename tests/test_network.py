import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.contracts import RESPONSE_FEATURES
from basketlens.operators import evaluation, network, response

DDL = "household_key int, data_split string, " + ", ".join(
    f"{name} double" for name in RESPONSE_FEATURES) + ", target_redeemed int"


@pytest.fixture(scope="module")
def learnable(spark):
    """A curved rule that no linear model can rank, with few positives and missing values."""
    rng, rows = random.Random(3), []
    for i in range(3000):
        x = [rng.uniform(-2, 2) for _ in RESPONSE_FEATURES]
        label = int(abs(x[0]) + 0.3 * rng.uniform(-1, 1) > 1.5)
        x[4] = None if i % 9 == 0 else x[4]
        rows.append((i, ("train", "train", "validation", "test")[i % 4], *x, label))
    return spark.createDataFrame(rows, DDL)


def flat_sums(data, standardizer, weights, positive_weight):
    """The same sums from plain Python numbers, row by row and unit by unit."""
    hidden, bias, output, last = weights.parts()
    total = np.zeros(len(weights.flat) + len(network.TOTALS))
    rows = data.select(standardizer.vector().alias("x"), "target_redeemed", "data_split").collect()
    n, m = hidden.shape
    for row in rows:
        if row.data_split == "test":
            continue
        sums = [sum(w * v for w, v in zip(unit, row.x)) + b for unit, b in zip(hidden, bias)]
        logit = sum(max(s, 0.0) * w for s, w in zip(sums, output)) + last
        y, train = row.target_redeemed, row.data_split == "train"
        loss = np.log1p(np.exp(-logit)) if y else np.log1p(np.exp(logit))
        if train:
            weight = positive_weight if y else 1.0
            slope = weight * (1 / (1 + np.exp(-logit)) - y)
            for u in range(n):
                total[n * m + n + u] += slope * max(sums[u], 0.0)
                if sums[u] > 0:
                    total[u * m:(u + 1) * m] += slope * output[u] * np.array(row.x)
                    total[n * m + u] += slope * output[u]
            total[n * m + 2 * n] += slope
            total[-5:] += [weight * loss, loss, 1, 0, 0]
        else:
            total[-5:] += [0, 0, 0, loss, 1]
    return total


def test_sums_over_tasks_equal_plain_arithmetic(learnable):
    s = response.Standardizer.fit(response.in_split(learnable, "train"))
    weights = network.initial_weights(len(RESPONSE_FEATURES), 5, 1)
    rows = learnable.where("data_split <> 'test'").select(
        s.vector().alias("x"), F.col("target_redeemed").cast("double").alias("y"),
        (F.col("data_split") == "train").alias("train"))
    network.with_package(learnable.sparkSession)
    expected = flat_sums(learnable, s, weights, 3.5)
    for parts in (1, 7):
        assert network.summed(rows.repartition(parts), weights, 3.5) == pytest.approx(
            expected, abs=1e-8)
    assert network.summed(rows.limit(0), weights, 3.5).tolist() == [0.0] * len(expected)


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(2)
    weights = network.initial_weights(4, 3, 7)
    x, y, train = rng.normal(size=(40, 4)), rng.integers(0, 2, 40).astype(float), rng.random(40) < 0.7
    sums = network.batch_sums(weights, x, y, train, 2.0)
    for place in range(len(weights.flat)):
        losses = []
        for step in (1e-6, -1e-6):
            moved = network.Weights(weights.flat.copy(), 4)
            moved.flat[place] += step
            losses.append(network.batch_sums(moved, x, y, train, 2.0)[len(weights.flat)])
        assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(sums[place], rel=1e-4, abs=1e-6)


def test_fit_beats_every_baseline_and_a_linear_model(learnable):
    s = response.Standardizer.fit(response.in_split(learnable, "train"))
    settings = {"hidden_units": 16, "weighted": False, "learning_rate": 0.05, "patience": 25}
    fit = network.fit_network(learnable, s, **settings)
    labels = ["data_split", "target_redeemed"]
    linear = response.apply_model(learnable.withColumn("CAMPAIGN", F.lit(1)), s, response.fit_logistic(
        response.in_split(learnable, "train"), s)).withColumn("linear", F.col("raw_probability"))
    scored = response.score(learnable, s, fit.network, keep=labels)
    long = (evaluation.long_scores(scored, {"network": "raw_probability"}, labels)
            .unionByName(evaluation.long_scores(linear, {"linear": "linear"}, labels))
            .unionByName(evaluation.long_scores(
                evaluation.baseline_scores(learnable), evaluation.BASELINES, labels)))
    found = {r.score_kind: r for r in evaluation.ranking_metrics(
        long.where("data_split = 'test'"), ["score_kind"]).collect()}
    best = found.pop("network")
    assert best.roc_auc > 0.9
    assert all(best.roc_auc > other.roc_auc for other in found.values())
    again = network.fit_network(learnable.repartition(3), s, **settings)
    assert again.best_step == fit.best_step
    assert np.ravel(again.network.hidden_weights) == pytest.approx(np.ravel(fit.network.hidden_weights))


def test_class_weights_raise_scores_and_validation_stays_unweighted(learnable):
    s = response.Standardizer.fit(response.in_split(learnable, "train"))
    plain, weighted = (network.fit_network(learnable, s, 4, w, max_steps=3, seed=5)
                       for w in (False, True))
    assert plain.positive_weight is None and weighted.positive_weight > 1.5
    first, second = plain.history[0], weighted.history[0]
    assert first["validation_loss"] == second["validation_loss"]
    assert first["training_unweighted_loss"] == second["training_unweighted_loss"]
    assert first["training_loss"] < second["training_loss"]
    means = [response.score(learnable, s, fit.network).agg(F.avg("raw_probability")).first()[0]
             for fit in (plain, weighted)]
    assert means[0] < means[1] or weighted.best_step == 0


def test_early_stop_keeps_the_best_weights(learnable):
    s = response.Standardizer.fit(response.in_split(learnable, "train"))
    noise = learnable.withColumn("target_redeemed", F.pmod(F.xxhash64("household_key"), F.lit(2)).cast("int"))
    fit = network.fit_network(noise, s, 16, False, learning_rate=0.1, max_steps=60, patience=4)
    losses = [step["validation_loss"] for step in fit.history]
    assert fit.early_stopped and len(losses) == fit.best_step + 4 + 1 < 61
    assert fit.best_validation_loss == losses[fit.best_step] == min(losses)
    kept = network.history_frame(fit, learnable).where("kept").collect()
    assert [row.step for row in kept] == [fit.best_step]
    assert not network.fit_network(noise, s, 4, False, max_steps=1).early_stopped


def test_both_classes_and_validation_rows_are_needed(learnable):
    s = response.Standardizer.fit(response.in_split(learnable, "train"))
    with pytest.raises(Exception, match="both classes"):
        network.fit_network(learnable.where("target_redeemed = 1"), s)
    with pytest.raises(ValueError, match="validation rows"):
        network.fit_network(learnable.where("data_split <> 'validation'"), s)
