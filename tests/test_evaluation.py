import math
import random

import pytest
from pyspark.sql import functions as F

from basketlens.contracts import RESPONSE_FEATURES
from basketlens.operators import evaluation, response


def scored(frame, rows):
    return frame([("g", float(s), y) for s, y in rows], "grp string, score double, target_redeemed int")


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (
        len(pos) * len(neg))


def brute_ap(rows):
    positives = sum(y for _, y in rows)
    total = 0.0
    for t in {s for s, _ in rows}:
        at = sum(y for s, y in rows if s == t)
        above = [y for s, y in rows if s >= t]
        total += at / positives * sum(above) / len(above)
    return total


def test_average_precision_of_full_tie(frame):
    row = evaluation.ranking_metrics(
        scored(frame, [(0.25, 1), (0.25, 0), (0.25, 0), (0.25, 1)]), ["grp"]).first()
    assert row.pr_auc_average_precision == 0.5 and row.roc_auc == 0.5


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_ranking_matches_brute_force_with_ties_and_wide_scores(frame, digits):
    rng = random.Random(digits)
    rows = [(round(rng.uniform(-0.3, 1.4), digits), int(rng.random() < 0.3)) for _ in range(300)]
    row = evaluation.ranking_metrics(scored(frame, rows), ["grp"]).first()
    assert row.roc_auc == pytest.approx(brute_auc(rows))
    assert row.pr_auc_average_precision == pytest.approx(brute_ap(rows))


def test_one_class_gives_nan(frame):
    row = evaluation.ranking_metrics(scored(frame, [(0.1, 0), (0.4, 0)]), ["grp"]).first()
    assert math.isnan(row.roc_auc) and math.isnan(row.pr_auc_average_precision)


def test_threshold_metrics_by_hand(frame):
    rows = [(0.9, 1), (0.5, 0), (0.4, 1), (0.1, 0)]
    row = evaluation.threshold_metrics(scored(frame, rows), ["grp"]).first()
    assert (row.true_positive, row.false_positive, row.false_negative, row.true_negative) == (
        1, 1, 1, 1)
    assert row.accuracy == row.precision == row.recall == row.f1 == 0.5
    assert row.brier_score == pytest.approx((0.01 + 0.25 + 0.36 + 0.01) / 4)
    assert row.log_loss == pytest.approx(-sum(map(math.log, (0.9, 0.5, 0.4, 0.9))) / 4)
    none = evaluation.threshold_metrics(scored(frame, [(0.1, 1), (0.2, 0)]), ["grp"]).first()
    assert none.precision == none.recall == none.f1 == 0.0


def test_reliability_bins_and_error(frame):
    data = scored(frame, [(0.05, 0), (0.25, 0), (0.75, 1), (0.95, 1)])
    bins = evaluation.reliability_bins(data, ["grp"], edges=[0.0, 0.5, 1.0])
    assert [r["count"] for r in bins.orderBy("bin").collect()] == [2, 2]
    error = evaluation.calibration_error(bins, ["grp"]).first().expected_calibration_error
    assert error == pytest.approx(0.15)


def test_scores_on_edges_fall_into_the_bin_they_open(frame):
    edges = [0.1 * i for i in range(10)] + [1.0]
    data = scored(frame, [(e, 1) for e in edges] + [(0.3, 0)])
    bins = evaluation.reliability_bins(data, ["grp"]).orderBy("bin").collect()
    # 0.3 is below the third multiple of 0.1 in binary, so it stays in bin 2.
    assert [r["count"] for r in bins] == [1, 1, 2, 1, 1, 1, 1, 1, 1, 2]
    assert bins[9].upper_inclusive and not bins[0].upper_inclusive


def test_platt_calibration(frame):
    data = frame(list(zip([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 2.0, 3.0], [0, 0, 1, 0, 0, 1, 1, 1])),
                 "logit double, target_redeemed int")
    fitted = response.fit_calibrator(data)
    assert fitted.slope == pytest.approx(1.4676153, abs=1e-4)
    assert fitted.intercept == pytest.approx(-0.4443737, abs=1e-4)
    assert response.Calibrator.load(fitted.frame(data.sparkSession)) == fitted
    with pytest.raises(ValueError):
        response.fit_calibrator(data.where("target_redeemed = 1"))
    with pytest.raises(ValueError):
        response.Calibrator(1.0, 0.0, fit_split="test")


def model_rows(frame, n=60, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.uniform(-1, 1) for _ in RESPONSE_FEATURES]
        x[3] = None if i % 7 == 0 else x[3]
        x[5] = 2.0
        rows.append((i, i % 3, "train", *x, int(x[0] + rng.uniform(-1, 1) > 0)))
    ddl = "household_key int, CAMPAIGN int, data_split string, " + ", ".join(
        f"{name} double" for name in RESPONSE_FEATURES) + ", target_redeemed int"
    return rows, frame(rows, ddl)


def test_standardizer_imputes_means_and_keeps_constant_columns(frame):
    rows, data = model_rows(frame)
    s = response.Standardizer.fit(data)
    third = [r[6] for r in rows]
    mean = sum(v for v in third if v is not None) / sum(v is not None for v in third)
    filled = [mean if v is None else v for v in third]
    spread = math.sqrt(sum((v - mean) ** 2 for v in filled) / len(filled))
    assert s.means[3] == pytest.approx(mean) and s.stds[3] == pytest.approx(spread)
    assert s.stds[5] == 1.0
    z = [r[0] for r in data.orderBy("household_key").select(s.column(RESPONSE_FEATURES[3])).collect()]
    assert z[0] == 0.0 and z[1] == pytest.approx((third[1] - mean) / spread)


def test_network_expression_matches_arithmetic(frame):
    _, data = model_rows(frame, 8)
    s = response.Standardizer.fit(data)
    net = response.FeedForward(((0.5,) * 14, (-0.25,) * 14), (0.1, -0.2), (2.0, -1.0), 0.3)
    rows = data.select(s.vector().alias("x"), net.logit(s.vector()).alias("logit")).collect()
    for row in rows:
        hidden = [max(0.0, sum(w * v for w, v in zip(ws, row.x)) + b)
                  for ws, b in zip(net.hidden_weights, net.hidden_bias)]
        assert row.logit == pytest.approx(2.0 * hidden[0] - hidden[1] + 0.3)


def test_fitted_models_rank_better_than_chance(frame):
    _, data = model_rows(frame, 200)
    s = response.Standardizer.fit(data)
    for fit in (response.fit_logistic, lambda d, z: response.fit_perceptron(d, z, 4, max_iter=20)):
        scores = response.apply_model(data, s, fit(data, s)).withColumn(
            "score", F.col("raw_probability"))
        assert evaluation.ranking_metrics(scores, ["data_split"]).first().roc_auc > 0.7
    with pytest.raises(Exception, match="both classes"):
        response.fit_logistic(data.where("target_redeemed = 1"), s)


def test_saved_model_scores_the_same(frame, tmp_path):
    _, data = model_rows(frame, 80)
    s = response.Standardizer.fit(data)
    fitted = response.fit_logistic(data, s, max_iter=10)
    response.save_model(str(tmp_path), s, fitted, response.Calibrator(0.5, -0.1))
    loaded, again, calibrator = response.load_model(str(tmp_path))
    assert loaded == s and calibrator.slope == 0.5

    def logits(standardizer, model):
        rows = response.apply_model(data, standardizer, model).orderBy("household_key").collect()
        return [r.logit for r in rows]

    assert logits(loaded, again) == logits(s, fitted)
    with pytest.raises(ValueError, match="other features"):
        response.load_model(str(tmp_path), RESPONSE_FEATURES[::-1])


@pytest.mark.parametrize("digits", [0, 1, 3])
def test_permutation_moves_one_feature_and_keeps_its_values(frame, digits, monkeypatch):
    monkeypatch.setattr(response, "BAND_DIGITS", digits)
    _, data = model_rows(frame, 30)
    s = response.Standardizer.fit(data)
    pick = response.FeedForward(((1.0,) + (0.0,) * 13,), (100.0,), (1.0,), -100.0)
    out = response.permuted_scores(data, s, pick, ["household_key", "CAMPAIGN"], 2, 9)
    plain = response.score(data, s, pick, keep=["household_key"])
    before = {r.household_key: r.raw_probability for r in plain.collect()}
    rows = out.collect()
    for repeat in (1, 2):
        first = {r.household_key: r.score for r in rows
                 if r.repeat == repeat and r.feature == RESPONSE_FEATURES[0]}
        other = {r.household_key: r.score for r in rows
                 if r.repeat == repeat and r.feature == RESPONSE_FEATURES[1]}
        assert sorted(first.values()) == pytest.approx(sorted(before.values()))
        assert sum(first[k] != pytest.approx(before[k]) for k in first) > 20
        assert other == pytest.approx(before)


@pytest.mark.parametrize("digits", [None, 2])
def test_counted_permutations_equal_scored_ones(frame, digits):
    _, data = model_rows(frame, 80)
    s = response.Standardizer.fit(data)
    rng = random.Random(1)
    net = response.FeedForward(tuple(tuple(rng.uniform(-1, 1) for _ in range(14)) for _ in range(5)),
                               (0.1, -0.3, 0.0, 0.2, 0.5), (1.0, -1.5, 0.7, 2.0, -0.4), -0.1)
    key = ["household_key", "CAMPAIGN"]
    scored = response.permuted_scores(data, s, net, key, 3, 9).withColumn(
        "score", F.round("score", 12 if digits is None else digits))
    expected = evaluation.score_counts(scored, ["feature", "repeat"])
    found = response.permuted_counts(data, s, net, key, 3, 9, digits).withColumn(
        "score", F.round("score", 12)).groupBy("feature", "repeat", "score").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos")).select(expected.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert response.permuted_counts(data.limit(0), s, net, key, 3, 9).count() == 0
