"""Choice of a model from its metrics, and comparison of runs under several definitions.

There are two choices. While training, the first model with the highest average precision wins. From stored metrics, ties of
average precision go by ROC-AUC, then by F1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD_COLUMNS = (
    "active_user_definition",
    "active_user_definition_detail",
    "churn_definition",
    "churn_definition_detail",
    "row_count",
    "feature_count",
    "snapshot_count",
)


# The order in which models with equal average precision are preferred.
MODEL_ORDER = ("logistic_regression", "random_forest", "boosted_balanced", "boosted_subsampled")


def preference() -> Column:
    """Position of ``model`` in MODEL_ORDER; models that are not listed come last."""
    place = F.array_position(F.array(*[F.lit(m) for m in MODEL_ORDER]), F.col("model"))
    return F.when(place > 0, place).otherwise(len(MODEL_ORDER) + 1)


def first_best_model(metrics: DataFrame) -> DataFrame:
    """The validation row with the highest average precision; of equal ones the first in MODEL_ORDER."""
    valid = metrics.filter(F.col("split") == "valid")
    return valid.orderBy(F.desc("pr_auc"), preference(), "model").limit(1)


def _by_metrics() -> list[Column]:
    """Higher metrics first and undefined ones last; full ties by MODEL_ORDER."""
    return [-F.coalesce(c, F.lit(-1.0)) for c in ("pr_auc", "auc", "f1")] + [preference(), F.col("model")]


def choose_best_model(metrics: DataFrame) -> DataFrame:
    """The validation row with the highest average precision, then ROC-AUC, then F1."""
    return metrics.filter(F.col("split") == "valid").orderBy(*_by_metrics()).limit(1)


def order_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.asc("split"), F.desc("pr_auc"), F.desc("auc"))


def compare_runs(records: DataFrame, metrics: DataFrame, refits: DataFrame) -> DataFrame:
    """One row per ``prefix``: run record, best validation model, and test metrics of the refitted model."""
    rank = F.struct(*_by_metrics())
    best = (
        metrics.filter(F.col("split") == "valid")
        .groupBy("prefix")
        .agg(F.min_by(F.struct("model", "auc", "pr_auc", "f1"), rank).alias("b"))
        .select(
            "prefix",
            F.col("b.model").alias("best_valid_model"),
            F.col("b.auc").alias("valid_auc"),
            F.col("b.pr_auc").alias("valid_pr_auc"),
            F.col("b.f1").alias("valid_f1"),
        )
    )
    refit = refits.select(
        "prefix",
        F.col("model").alias("test_refit_model"),
        F.col("auc").alias("test_refit_auc"),
        F.col("pr_auc").alias("test_refit_pr_auc"),
        F.col("f1").alias("test_refit_f1"),
        F.col("positive_rate").alias("test_positive_rate"),
    )
    return records.select("prefix", *RECORD_COLUMNS).join(best, "prefix").join(refit, "prefix")
