"""Spark ML models on the feature table: registry, training, choice, refit, importance.

The features are assembled to vectors and stored once; every fit and score reads these, and the fits run side by side. A fitted model holds
the assembler too, so it can be saved and applied to a feature table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.feature import DCT, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.config import ChurnConfig
from ebbline.operators.comparison import first_best_model, order_metrics
from ebbline.operators.errors import error_feature_means, error_profile, value_segments, with_features, worst_cases
from ebbline.operators.metrics import binary_metrics, prediction_frame
from ebbline.operators.sampling import cap_rows
from ebbline.plans.ensembles import fit_forest, penalised_leaves
from ebbline.plans.threads import THREADS, concurrently
from ebbline.session import stage
from ebbline.sources import results

# Training row caps per kind of model (the default of ``caps``), and the parameters in the registry below.
ROW_CAPS = {
    "logistic_regression": 1_200_000,
    "random_forest": 300_000,
    "boosted_balanced": 1_500_000,
    "boosted_subsampled": 1_200_000,
}
WEIGHTED = ("logistic_regression", "boosted_balanced")  # the forest weighs classes in each bootstrap
ALL_ROWS: dict[str, int] = {}  # as ``caps``: no model's training rows are capped
# Rows in a partition on which the linear model is fitted. It passes over its rows up to hundreds of times, so a pass
# has no more tasks than these rows need, however many files the table has.
FIT_ROWS = 100_000
# Least curvature of a row in a Newton step, for rows whose probability is 0 or 1 to the last digit; the minimum does not depend on it.
LEAST_CURVE = 1e-6
LEAST_GAIN = 1e-9
STEP = 0.05
LEAF_PENALTY = 1.0


@dataclass(frozen=True)
class Effort:
    """Size of the ensembles, iterations of the linear model and steps of its ``newton_steps``."""

    trees: int = 300
    bootstraps: int = 30
    rounds: int = 400
    forest_depth: int = 12
    boost_depth: int = 6
    iterations: int = 1000
    newton: int = 0


FULL = Effort(newton=8)
FAST = Effort(trees=10, bootstraps=2, rounds=5, forest_depth=4, boost_depth=3, iterations=30)


def feature_names(table: DataFrame, cfg: ChurnConfig) -> list[str]:
    """Numeric and boolean columns that are neither keys nor derived from the label window."""
    dropped = {
        "client_id",
        "snapshot_date",
        "split",
        "churn",
        f"future_buy_count_{cfg.label_days}d",
        f"future_active_days_{cfg.label_days}d",
    }
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in table.schema if isinstance(f.dataType, kinds) and f.name not in dropped]


def assembler(names: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")


def assembled(table: DataFrame, names: list[str]) -> DataFrame:
    """Keys, label and split (if there) with the features as one vector; missing features count as 0. Lazy."""
    if "features" in table.columns:
        return table
    kept = [c for c in ("client_id", "snapshot_date", "churn", "split") if c in table.columns]
    return assembler(names).transform(table.na.fill(0, names)).select(*kept, "features")


def _scaled(model) -> list:
    """Scaled features and a constant 1 in the place of an intercept, so that it is penalised like the other coefficients. The
    optimiser passes over constant columns; a cosine transform, which is a rotation and so leaves penalty and loss as they are, spreads the
    constant over all inputs."""
    return [
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        SQLTransformer(statement="SELECT *, 1D AS one FROM __THIS__"),
        VectorAssembler(inputCols=["scaled", "one"], outputCol="with_one"),
        DCT(inputCol="with_one", outputCol="inputs"),
        model,
    ]


def model_registry(n_rows: int, seed: int = 42, effort: Effort = FULL) -> dict[str, Callable]:
    """Unfitted pipelines on assembled rows, in the order in which ties between models are resolved.

    Class weights average to one, so the logistic penalty of strength 1 is ``1 / n_rows`` here.
    """
    common = {"featuresCol": "features", "labelCol": "churn"}
    return {
        "logistic_regression": lambda: _scaled(
            LogisticRegression(
                maxIter=effort.iterations,
                tol=1e-9,
                regParam=1.0 / max(n_rows, 1),
                standardization=False,
                fitIntercept=False,
                weightCol="weight",
                **common | {"featuresCol": "inputs"},
            )
        ),
        "random_forest": lambda trees=effort.trees: [
            RandomForestClassifier(
                numTrees=trees,
                maxDepth=effort.forest_depth,
                minInstancesPerNode=10,
                featureSubsetStrategy="sqrt",
                weightCol="weight",
                **common,
            )
        ],
        "boosted_balanced": lambda: [
            GBTClassifier(
                maxIter=effort.rounds,
                stepSize=STEP,
                maxDepth=effort.boost_depth,
                featureSubsetStrategy="0.8",
                weightCol="weight",
                seed=seed,
                **common,
            )
        ],
        "boosted_subsampled": lambda: [
            GBTClassifier(
                maxIter=effort.rounds,
                stepSize=STEP,
                maxDepth=effort.boost_depth,
                subsamplingRate=0.8,
                featureSubsetStrategy="0.8",
                seed=seed,
                **common,
            )
        ],
    }


def class_weights(train: DataFrame) -> DataFrame:
    """Weight of each row: rows / (2 * rows of its class)."""
    counts = {r.churn: r["n"] for r in train.groupBy("churn").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    weights = F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, total / (len(counts) * n))])
    return train.withColumn("weight", weights[F.col("churn")])


def few_partitions(rows: DataFrame, n_rows: int) -> DataFrame:
    return rows.repartition(max(1, -(-n_rows // FIT_ROWS)))


def with_coefficients(model: LogisticRegressionModel, coefficients: Vector) -> LogisticRegressionModel:
    context = SparkContext._active_spark_context
    made = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(model.uid, _py2java(context, coefficients), 0.0)
    return model._copyValues(LogisticRegressionModel(made))


def newton_steps(stages: list, rows: DataFrame, steps: int) -> list:
    """A linear model on which the optimiser spent all its iterations, moved on to the minimum of its loss in at most ``steps`` Newton steps.

    A step is a least-squares fit, under the same penalty, of margin plus pull over curvature, weighted by curvature. Its sums, a number for each
    two inputs, come from a pass over the rows where they are. A step that does not lower the loss is not taken; that one, or one that gains less
    than a billionth of the loss, is the last, since what is left to gain shrinks by squares.
    """
    *before, model = stages
    if not steps or model.summary.totalIterations < model.getMaxIter():
        return stages
    inputs = PipelineModel(before).transform(rows).select("weight", "churn", "inputs").persist()
    z, churn, weight = vector_to_array("rawPrediction")[1], F.col("churn"), F.col("weight")
    p = 1 / (1 + F.exp(-z))
    curve = F.greatest(p * (1 - p), F.lit(LEAST_CURVE))
    loss = weight * (F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - churn * z)
    columns = ["inputs", (weight * curve).alias("curve"), (z + (churn - p) / curve).alias("response"), loss.alias("loss")]

    def at(model: LogisticRegressionModel) -> tuple[DataFrame, float, float]:
        """Rows, loss, and the strength that makes Spark's penalty, which it divides by the response's deviation, half the squared coefficients."""
        found = model.transform(inputs).select(columns)
        of_curve = [F.sum(F.col("curve") * F.col("response") ** k).alias(f"m{k}") for k in range(3)]
        sums = found.agg(F.sum("loss").alias("loss"), *of_curve).first()
        deviation = max(sums.m2 / sums.m0 - (sums.m1 / sums.m0) ** 2, 0.0) ** 0.5
        return found, sums.loss + model.coefficients.dot(model.coefficients) / 2, deviation / sums.m0

    found, lowest, penalty = at(model)
    for _ in range(steps):
        least_squares = LinearRegression(
            featuresCol="inputs", labelCol="response", weightCol="curve", regParam=penalty,
            fitIntercept=False, standardization=False, solver="normal",
        )
        moved = with_coefficients(model, least_squares.fit(found).coefficients)
        found, total, penalty = at(moved)
        if not total < lowest:
            break
        gained, model, lowest = lowest - total, moved, total
        if gained < LEAST_GAIN * lowest:
            break
    inputs.unpersist()
    return [*before, model]


def fit(
    train: DataFrame, model: str, names: list[str], seed: int = 42, effort: Effort = FULL, caps: dict[str, int] = ROW_CAPS
) -> PipelineModel:
    """Fit on at most ``caps[model]`` rows, a stratified sample by hash, or on all rows of a model without cap. ``train`` is a feature
    table or already assembled."""
    capped = cap_rows(assembled(train, names), caps.get(model), seed)
    weighted = class_weights(capped) if model in WEIGHTED else capped
    n_rows = weighted.count()
    unfitted = model_registry(n_rows, seed, effort)[model]
    if model == "random_forest":
        stages = fit_forest(capped, lambda trees: unfitted(trees)[0], effort.trees, effort.bootstraps, seed)
    else:
        rows = few_partitions(weighted, n_rows) if model == "logistic_regression" else weighted
        stages = Pipeline(stages=unfitted()).fit(rows).stages
    if model == "logistic_regression":
        stages = newton_steps(stages, weighted, effort.newton)
    if model == "boosted_subsampled":
        stages = penalised_leaves(stages[0], capped, STEP, LEAF_PENALTY)
    return PipelineModel([assembler(names), *stages])


def score(fitted: PipelineModel, rows: DataFrame, names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Probability of churn per row, with the keys and the columns to ``keep``."""
    scored = PipelineModel(fitted.stages[1:]).transform(assembled(rows, names))
    return scored.select(
        "client_id",
        "snapshot_date",
        F.col("churn").cast("int").alias("y_true"),
        vector_to_array("probability")[1].alias("y_score"),
        *keep,
    )


def linear_coefficients(fitted: PipelineModel) -> np.ndarray:
    """Coefficients of the scaled features and, last, the intercept: the model's own ones turned back."""
    own = fitted.stages[-1].coefficients.toArray()
    n = len(own)
    at = np.arange(n)
    turn = np.cos(np.pi * at[:, None] * (2 * at + 1) / (2 * n)) * np.sqrt(2 / n)
    turn[0] /= np.sqrt(2)
    return own @ turn


def logistic_gradient(fitted: PipelineModel, train: DataFrame, names: list[str]) -> DataFrame:
    """``position, coefficient, gradient`` of the penalised weighted log loss at the fitted coefficients, all 0 at the optimum. It is computed from
    the rows alone: weights, scaled inputs and coefficients, without the optimiser's own summary."""
    coefficients = [float(c) for c in fitted.stages[-1].coefficients.toArray()]
    inputs = PipelineModel(fitted.stages[1:-1]).transform(class_weights(assembled(train, names)))
    rows = inputs.select("weight", "churn", vector_to_array("inputs").alias("x"))
    beta = F.array(*[F.lit(c) for c in coefficients])
    z = F.aggregate(F.zip_with("x", beta, lambda x, b: x * b), F.lit(0.0), lambda a, x: a + x)
    pulls = rows.select("weight", "x", (F.col("weight") * (1 / (1 + F.exp(-z)) - F.col("churn"))).alias("pull"))
    each = pulls.select("weight", "pull", F.posexplode("x").alias("position", "value"))
    sums = each.groupBy("position").agg(F.sum(F.col("pull") * F.col("value")).alias("loss"), F.sum("weight").alias("n"))
    own = F.element_at(beta, F.col("position") + 1)
    return sums.select("position", own.alias("coefficient"), ((F.col("loss") + own) / F.col("n")).alias("gradient"))


def feature_importance(spark: SparkSession, fitted: PipelineModel, names: list[str], keep: int = 50) -> DataFrame:
    """The ``keep`` most important features; absolute coefficients for the linear model."""
    trees = [part for part in fitted.stages if hasattr(part, "featureImportances")]
    if trees:
        values = np.average([t.featureImportances.toArray() for t in trees], axis=0, weights=[t.getNumTrees for t in trees])
    else:
        values = abs(linear_coefficients(fitted)[:-1])
    rows = [(name, float(value)) for name, value in zip(names, values)]
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(keep)
    )


@dataclass(frozen=True)
class TrainingRun:
    metrics: DataFrame
    best_model: str
    refit_metrics: DataFrame
    refit_importance: DataFrame
    predictions: DataFrame


def train_and_evaluate(
    table: DataFrame,
    cfg: ChurnConfig,
    models: tuple[str, ...] = tuple(ROW_CAPS),
    effort: Effort = FULL,
    output: str | None = None,
    caps: dict[str, int] = ROW_CAPS,
    threads: int = THREADS,
) -> TrainingRun:
    """Fit every model on train, ``threads`` at a time, score valid and test, refit the best on train + valid, score test once.

    ``table`` must be stored (it is read many times). With ``output`` models, predictions, metrics, error analysis
    and importances are written below that folder.
    """
    spark = table.sparkSession
    names = feature_names(table, cfg)
    vectors = stage(assembled(table, names), "assembled")
    train, held_out = vectors.filter("split = 'train'"), vectors.filter("split IN ('valid', 'test')")
    fits = concurrently(spark, {model: partial(fit, train, model, names, cfg.seed, effort, caps) for model in models}, threads)
    scored = []
    for model, fitted in fits.items():
        scored.append(score(fitted, held_out, names, ("split",)).withColumn("model", F.lit(model)))
        if output:
            results.save_model(fitted, f"{output}/models/{model}")
            results.write_csv(feature_importance(spark, fitted, names), f"{output}/feature_importance_{model}")
    predictions = stage(reduce(DataFrame.unionByName, scored), "model-predictions")
    metrics = order_metrics(stage(binary_metrics(predictions, ("model", "split")), "metrics"))
    best = first_best_model(metrics).first().model

    refitted = fit(vectors.filter("split IN ('train', 'valid')"), best, names, cfg.seed, effort, caps)
    refit_scores = score(refitted, vectors.filter("split = 'test'"), names)
    tags = {"model": F.lit(best), "split": F.lit("test_refit")}
    refit_metrics = stage(binary_metrics(refit_scores.withColumns(tags), ("model", "split")), "refit-metrics")
    importance = feature_importance(spark, refitted, names)
    if output:
        results.save_model(refitted, f"{output}/models/{best}_refit")
        results.write_csv(metrics, f"{output}/metrics")
        results.write_csv(refit_metrics, f"{output}/best_model_test_metrics")
        results.write_csv(importance, f"{output}/feature_importance_{best}_refit")
        for model in models:
            for split in ("valid", "test"):
                part = predictions.filter((F.col("model") == model) & (F.col("split") == split))
                frame = prediction_frame(part)
                results.write_csv(frame, f"{output}/{model}_{split}_predictions")
                if split == "test":
                    write_error_analysis(frame, table, names, cfg, f"{output}/{model}_{split}")
    return TrainingRun(metrics, best, refit_metrics, importance, predictions)


def write_error_analysis(frame: DataFrame, table: DataFrame, names: list[str], cfg: ChurnConfig, prefix: str) -> None:
    obs = cfg.observation_days
    buys = f"product_buy_count_{obs}d"
    merged = with_features(frame, table.select("client_id", "snapshot_date", *names))
    segmented = stage(value_segments(merged, buys), "segmented")
    results.write_csv(error_profile(segmented, buys, f"active_days_{obs}d"), f"{prefix}_error_profile")
    for kind in ("false_positive", "false_negative"):
        results.write_csv(worst_cases(segmented, kind), f"{prefix}_{kind}_examples")
        results.write_csv(error_feature_means(segmented, kind), f"{prefix}_{kind}_feature_means")
