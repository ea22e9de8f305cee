"""Response model: preprocessing, fitting, frozen scoring, calibration, sensitivity."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketlens.contracts import RESPONSE_FEATURES
from basketlens.functions.probability import platt, sigmoid
from basketlens.operators.evaluation import counted_loss_and_precision, loss_and_precision
from basketlens.sources.session import with_package
from basketlens.sources.sinks import stored


def in_split(dataset: DataFrame, split: str) -> DataFrame:
    return dataset.where(F.col("data_split") == split)


def feature_statistics(train: DataFrame,
                       features: Sequence[str] = RESPONSE_FEATURES) -> DataFrame:
    """Mean and imputed population deviation per feature, from one pass over training rows.

    Missing values are replaced by the mean, so they add nothing to the squared
    deviations but do count as rows.
    """
    def spread(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.stddev_pop(value) * F.sqrt(F.count(value) / F.count(F.lit(1)))

    wide = train.agg(F.map_from_arrays(
        F.array(*[F.lit(name) for name in features]),
        F.array(*[F.struct(F.avg(F.col(name).cast("double")).alias("mean"),
                           spread(name).alias("std")) for name in features])).alias("stats"))
    row = wide.select(F.explode("stats").alias("feature", "stat"))
    std = F.col("stat.std")
    usable = (std > 0) & (std < math.inf)
    return row.select(
        "feature", F.coalesce(F.col("stat.mean"), F.lit(0.0)).alias("mean"),
        F.when(usable, std).otherwise(1.0).alias("std"))


@dataclass(frozen=True)
class Standardizer:
    """Training means and deviations; a fixed number of scalars whatever the data size."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    @classmethod
    def fit(cls, train: DataFrame,
            features: Sequence[str] = RESPONSE_FEATURES) -> "Standardizer":
        rows = {r.feature: r for r in feature_statistics(train, features).collect()}
        return cls(tuple(features), tuple(rows[f].mean for f in features),
                   tuple(rows[f].std for f in features))

    def frame(self, spark: SparkSession) -> DataFrame:
        """The parameters as a table in feature order, for storing with the model."""
        return spark.createDataFrame(
            list(zip(range(len(self.features)), self.features, self.means, self.stds)),
            "place int, feature string, mean double, std double")

    @classmethod
    def load(cls, table: DataFrame) -> "Standardizer":
        rows = table.orderBy("place").collect()
        return cls(*(tuple(r[name] for r in rows) for name in ("feature", "mean", "std")))

    def column(self, name: str) -> Column:
        i = self.features.index(name)
        value = F.coalesce(F.col(name).cast("double"), F.lit(self.means[i]))
        return (value - F.lit(self.means[i])) / F.lit(self.stds[i])

    def vector(self) -> Column:
        """Standardized inputs as an array, in feature order."""
        return F.array(*[self.column(name) for name in self.features])


def class_balance(train: DataFrame) -> DataFrame:
    """Class counts and the weight of a positive row; one row."""
    positives = F.count_if(F.col("target_redeemed") == 1)
    negatives = F.count_if(F.col("target_redeemed") == 0)
    return train.agg(positives.alias("positives"), negatives.alias("negatives")).withColumn(
        "positive_weight",
        F.when((F.col("positives") > 0) & (F.col("negatives") > 0),
               F.col("negatives") / F.col("positives"))
        .otherwise(F.raise_error(F.lit("training data must hold both classes")).cast("double")))


def _literals(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(value)) for value in values])


def _dot(weights: Column, values: Column, start: Column) -> Column:
    return F.aggregate(F.zip_with(weights, values, lambda weight, value: weight * value), start,
                       lambda total, term: total + term)


@dataclass(frozen=True)
class FeedForward:
    """A frozen network with one ReLU layer, evaluated as a column expression."""

    hidden_weights: tuple[tuple[float, ...], ...]
    hidden_bias: tuple[float, ...]
    output_weights: tuple[float, ...]
    output_bias: float

    def preactivations(self, inputs: Column) -> Column:
        """Weighted sums of the hidden units before the ReLU, as an array."""
        units = F.array(*[F.struct(_literals(row).alias("w"), F.lit(float(bias)).alias("b"))
                          for row, bias in zip(self.hidden_weights, self.hidden_bias)])
        return F.transform(units, lambda unit: _dot(unit["w"], inputs, unit["b"]))

    def shifted(self, preactivations: Column, feature: Column, change: Column) -> Column:
        """Preactivations after one input changed; costs one product per hidden unit."""
        by_feature = F.array(*[_literals(column) for column in zip(*self.hidden_weights)])
        return F.zip_with(preactivations, F.get(by_feature, feature),
                          lambda total, weight: total + weight * change)

    def head(self, preactivations: Column) -> Column:
        """The logit of given preactivations."""
        hidden = F.transform(preactivations, lambda total: F.greatest(F.lit(0.0), total))
        return _dot(_literals(self.output_weights), hidden, F.lit(float(self.output_bias)))

    def logit(self, inputs: Column) -> Column:
        return self.head(self.preactivations(inputs))


@dataclass(frozen=True)
class Calibrator:
    """Platt parameters with the split they were fitted on."""

    slope: float
    intercept: float
    fit_split: str = "validation"
    fit_rows: int | None = None
    fit_positive_rows: int | None = None

    def __post_init__(self) -> None:
        if not (math.isfinite(self.slope) and math.isfinite(self.intercept)):
            raise ValueError("calibration parameters must be finite")
        if not self.fit_split.startswith("validation"):
            raise ValueError("a calibrator must be fitted on validation rows only")

    def probability(self, logit: Column) -> Column:
        return platt(logit, self.slope, self.intercept)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The parameters as a one-row table, for storing with the model."""
        return spark.createDataFrame(
            [("platt_scaling", self.slope, self.intercept, self.fit_split, self.fit_rows,
              self.fit_positive_rows)],
            "method string, slope double, intercept double, fit_split string, "
            "fit_rows long, fit_positive_rows long")

    @classmethod
    def load(cls, table: DataFrame) -> "Calibrator":
        row = table.first()
        if row.method != "platt_scaling":
            raise ValueError(f"unknown calibration method {row.method!r}")
        return cls(row.slope, row.intercept, row.fit_split, row.fit_rows, row.fit_positive_rows)


def score(dataset: DataFrame, standardizer: Standardizer, network: FeedForward,
          calibrator: Calibrator | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Raw logit and probability, and the calibrated one if there is a calibrator.

    Only ``keep`` and the features are read; labels are not unless asked for.
    """
    logits = dataset.select(*keep, network.logit(standardizer.vector()).alias("logit"))
    scored = logits.withColumn("raw_probability", sigmoid(F.col("logit")))
    if calibrator is None:
        return scored
    return scored.withColumn(
        "calibrated_response_probability", calibrator.probability(F.col("logit")))


def _newton_logistic(max_iter: int = 50) -> GeneralizedLinearRegression:
    """Maximum likelihood by weighted least squares: few passes over the rows."""
    return GeneralizedLinearRegression(family="binomial", link="logit", weightCol="weight",
                                       regParam=0.0, tol=1e-12, maxIter=max_iter)


def fit_calibrator(validation: DataFrame, logit: str = "logit",
                   label: str = "target_redeemed") -> Calibrator:
    """Maximum-likelihood slope and intercept on validation logits."""
    classes = validation.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(label).alias("positives")).first()
    if not classes.rows or not 0 < classes.positives < classes.rows:
        raise ValueError("calibration needs validation rows of both classes")
    counted = validation.groupBy(F.col(logit).cast("double").alias("x"),
                                 F.col(label).cast("double").alias("label")).agg(
        F.count(F.lit(1)).cast("double").alias("weight"))
    fitted = _newton_logistic().fit(counted.select(
        array_to_vector(F.array("x")).alias("features"), "label", "weight"))
    return Calibrator(float(fitted.coefficients[0]), float(fitted.intercept), "validation",
                      classes.rows, classes.positives)


def _learning_frame(dataset: DataFrame, standardizer: Standardizer,
                    weight: float | None) -> DataFrame:
    keep = [name for name in ("household_key", "CAMPAIGN", "data_split") if name in dataset.columns]
    label = F.col("target_redeemed").cast("double")
    return dataset.select(
        *keep, label.alias("label"),
        F.when(label == 1, F.lit(weight or 1.0)).otherwise(1.0).alias("weight"),
        *[standardizer.column(name).alias(name) for name in standardizer.features])


def fit_logistic(train: DataFrame, standardizer: Standardizer,
                 weighted: bool = True, max_iter: int = 50) -> PipelineModel:
    """Class-weighted logistic regression on standardized features."""
    weight = class_balance(train).first().positive_weight if weighted else None
    assembler = VectorAssembler(inputCols=list(standardizer.features), outputCol="features")
    return Pipeline(stages=[assembler, _newton_logistic(max_iter)]).fit(
        _learning_frame(train, standardizer, weight))


def fit_perceptron(train: DataFrame, standardizer: Standardizer, hidden_units: int = 32,
                   seed: int = 20260929, max_iter: int = 100) -> PipelineModel:
    """Non-linear alternative with one hidden layer; it takes no class weights."""
    class_balance(train).first()
    assembler = VectorAssembler(inputCols=list(standardizer.features), outputCol="features")
    estimator = MultilayerPerceptronClassifier(
        layers=[len(standardizer.features), hidden_units, 2], seed=seed, maxIter=max_iter)
    return Pipeline(stages=[assembler, estimator]).fit(
        _learning_frame(train, standardizer, None))


def linear_logit(model: GeneralizedLinearRegressionModel, standardizer: Standardizer) -> Column:
    """A fitted logistic regression as one column expression, inside generated code."""
    terms = [F.lit(float(weight)) * standardizer.column(name) for weight, name in zip(
        model.coefficients, standardizer.features)]
    return reduce(lambda total, term: total + term, terms, F.lit(float(model.intercept)))


def apply_model(dataset: DataFrame, standardizer: Standardizer,
                model: PipelineModel) -> DataFrame:
    """Logit and probability of a fitted pipeline for every row."""
    keep = ["household_key", "CAMPAIGN", "data_split", "target_redeemed"]
    fitted = model.stages[-1]
    if isinstance(fitted, GeneralizedLinearRegressionModel):
        scored = dataset.select(*keep, linear_logit(fitted, standardizer).alias("logit"))
    else:
        raw = vector_to_array("rawPrediction")
        scored = model.transform(_learning_frame(dataset, standardizer, None)).select(
            *keep[:3], F.col("label").cast("int").alias("target_redeemed"),
            (F.get(raw, F.lit(1)) - F.get(raw, F.lit(0))).alias("logit"))
    return scored.withColumn("raw_probability", sigmoid(F.col("logit")))


def save_model(folder: str, standardizer: Standardizer, model: PipelineModel,
               calibrator: Calibrator) -> None:
    """Write everything that scoring needs: inputs, classifier and calibration."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{folder}/classifier")
    for name, table in (("standardizer", standardizer.frame(spark)),
                        ("calibrator", calibrator.frame(spark))):
        table.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def load_model(folder: str, features: Sequence[str] = RESPONSE_FEATURES
               ) -> tuple[Standardizer, PipelineModel, Calibrator]:
    """Read a saved model; its inputs must be the given features in the same order."""
    spark = SparkSession.active()
    standardizer = Standardizer.load(spark.read.parquet(f"{folder}/standardizer"))
    if standardizer.features != tuple(features):
        raise ValueError("the saved model was fitted on other features or another order")
    calibrator = Calibrator.load(spark.read.parquet(f"{folder}/calibrator"))
    return standardizer, PipelineModel.load(f"{folder}/classifier"), calibrator


#: Leading hexadecimal digits of a row's digest that name its band of the ring.
BAND_DIGITS = 3


def _with_donors(validation: DataFrame, standardizer: Standardizer, key: Sequence[str],
                 keep: Sequence[str], repeats: int, seed: int) -> DataFrame:
    """Every row once per repeat, with its inputs x and those of another row, the donor.

    A repeat orders rows by a seeded hash and hands each row its successor's
    inputs, the last row the first one's: a random cyclic permutation of all rows.
    Rows are ordered within bands of the hash, and the last row of a band takes the
    first row of the next band that has any, so no task orders all rows.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("repeat").cast("string"),
                               *[F.col(name).cast("string") for name in key]))
    rows = (validation.select(*key, "target_redeemed", standardizer.vector().alias("x"))
            .withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
            .select(*keep, "target_redeemed", "x", "repeat", digest.alias("digest"))
            .withColumn("band", F.substring("digest", 1, BAND_DIGITS)))
    bands = Window.partitionBy("repeat").orderBy("band")
    ring = bands.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = (rows.groupBy("repeat", "band").agg(F.min_by("x", "digest").alias("head"))
             .select("repeat", "band", F.coalesce(
                 F.lead("head").over(bands), F.first("head").over(ring)).alias("next_head")))
    order = Window.partitionBy("repeat", "band").orderBy("digest")
    return (rows.withColumn("follower", F.lead("x").over(order))
            .join(heads, ["repeat", "band"])
            .select(*keep, "repeat", "target_redeemed", "x",
                    F.coalesce("follower", "next_head").alias("donor")))


def permuted_scores(validation: DataFrame, standardizer: Standardizer, network: FeedForward,
                    key: Sequence[str], repeats: int, seed: int) -> DataFrame:
    """Score every row with one feature at a time taken from its donor.

    Only the changed input is added to the hidden sums, which are computed once per row.
    """
    names = list(standardizer.features)
    rows = _with_donors(validation, standardizer, key, key, repeats, seed).withColumn(
        "sums", network.preactivations(F.col("x")))
    feature = F.col("feature_index")
    change = F.get("donor", feature) - F.get("x", feature)
    shifted = network.shifted(F.col("sums"), feature, change)
    return (rows.withColumn("feature_index", F.explode(
                F.sequence(F.lit(0), F.lit(len(names) - 1))))
            .select(*key, "repeat", "target_redeemed",
                    F.get(F.array(*[F.lit(n) for n in names]), feature).alias("feature"),
                    sigmoid(network.head(shifted)).alias("score")))


def _count_scores(batches: Iterator[pa.RecordBatch], network: FeedForward, digits: int | None
                  ) -> Iterator[pa.RecordBatch]:
    """Rows and positives per feature, repeat and distinct score of each batch."""
    hidden, output = np.array(network.hidden_weights), np.array(network.output_weights)
    inputs = hidden.shape[1]
    for batch in batches:
        repeat, label = (batch.column(i).to_numpy() for i in (0, 1))
        x, donor = (batch.column(i).flatten().to_numpy().reshape(-1, inputs) for i in (2, 3))
        sums = x @ hidden.T + np.array(network.hidden_bias)
        for feature in range(inputs):
            moved = sums + (donor[:, feature] - x[:, feature])[:, None] * hidden[:, feature]
            logit = np.maximum(moved, 0.0) @ output + network.output_bias
            scores = 1.0 / (1.0 + np.exp(-np.clip(logit, -700, 700)))
            if digits is not None:
                scores = np.round(scores, digits)
            order = np.lexsort((scores, repeat))
            r, s = repeat[order], scores[order]
            first = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (s[1:] != s[:-1]))[:len(r)])
            if len(first):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), feature, np.int32)), pa.array(r[first]),
                     pa.array(s[first]), pa.array(np.diff(np.append(first, len(r)))),
                     pa.array(np.add.reduceat(label[order], first))],
                    names=["feature_index", "repeat", "score", "n", "pos"])


def permuted_counts(validation: DataFrame, standardizer: Standardizer, network: FeedForward,
                    key: Sequence[str], repeats: int, seed: int, digits: int | None = None
                    ) -> DataFrame:
    """Rows and positives per feature, repeat and score, as of ``permuted_scores``.

    All features of a batch of rows are scored as arrays and counted before any exchange, so
    rows are multiplied by repeats for their donors, never by features.
    """
    with_package(validation.sparkSession)
    rows = _with_donors(validation, standardizer, key, (), repeats, seed).select(
        F.col("repeat").cast("int"), F.col("target_redeemed").cast("long"), "x", "donor")
    counted = rows.mapInArrow(lambda batches: _count_scores(batches, network, digits),
                              "feature_index int, repeat int, score double, n long, pos long")
    names = F.array(*[F.lit(name) for name in standardizer.features])
    return (counted.groupBy("feature_index", "repeat", "score")
            .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
            .withColumn("feature", F.get(names, F.col("feature_index"))).drop("feature_index"))


def permutation_importance(validation: DataFrame, standardizer: Standardizer,
                           network: FeedForward, key: Sequence[str] = ("household_key", "CAMPAIGN"),
                           repeats: int = 10, seed: int = 20260929,
                           digits: int | None = None) -> DataFrame:
    """Drop in average precision and rise in log loss when a feature is permuted.

    ``digits`` rounds scores first, so that engines that sum in different
    orders agree on which scores are tied.
    """
    plain = score(validation, standardizer, network, keep=["target_redeemed"]).select(
        "target_redeemed", F.col("raw_probability").alias("score"), F.lit(0).alias("base"))
    if digits is not None:
        plain = plain.withColumn("score", F.round("score", digits))
    base = loss_and_precision(plain, ["base"], eps=1e-7).select(F.struct("loss", "precision")).scalar()
    base_loss, base_precision = base["loss"], base["precision"]
    # Ranking reads the counts several times, so they are written once.
    counts = stored(permuted_counts(validation, standardizer, network, key, repeats, seed, digits),
                    f"permuted-{uuid4().hex}")
    permuted = counted_loss_and_precision(counts, ["feature", "repeat"], eps=1e-7)
    return (permuted.select(
        "feature", (base_precision - F.col("precision")).alias("decrease"),
        (F.col("loss") - base_loss).alias("increase"))
        .groupBy("feature").agg(
            F.avg("decrease").alias("mean_average_precision_decrease"),
            F.stddev_pop("decrease").alias("std_average_precision_decrease"),
            F.avg("increase").alias("mean_log_loss_increase"))
        .orderBy(F.desc("mean_average_precision_decrease"), "feature"))
