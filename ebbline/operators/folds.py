"""Expanding-window folds: train on everything before the validation date, test on the date after it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.scalar import ratio_or_null


@dataclass(frozen=True)
class Fold:
    fold_id: int
    train_dates: tuple[dt.date, ...]
    valid_date: dt.date
    test_date: dt.date


def rolling_folds(dates: Sequence[dt.date], min_train: int = 3) -> list[Fold]:
    if len(dates) < min_train + 2:
        raise ValueError("a rolling backtest needs at least min_train + 2 snapshots")
    dates = sorted(dates)
    return [
        Fold(number, tuple(dates[: min_train + number - 1]), dates[min_train + number - 1], dates[min_train + number])
        for number in range(1, len(dates) - min_train)
    ]


def fold_frame(spark: SparkSession, folds: Sequence[Fold]) -> DataFrame:
    schema = "fold_id int, train_dates array<date>, valid_date date, test_date date"
    rows = [(f.fold_id, list(f.train_dates), f.valid_date, f.test_date) for f in folds]
    return spark.createDataFrame(rows, schema)


def fold_members(table: DataFrame, folds: Sequence[Fold]) -> DataFrame:
    """Validation and test rows of every fold with ``fold_id`` and ``split``. A date takes part in at most two
    folds here, so rows are repeated at most twice and no join is needed."""
    parts = F.array(
        *[
            F.struct(F.lit(f.fold_id).alias("fold_id"), F.lit(split).alias("split"), F.lit(date).alias("date"))
            for f in folds
            for split, date in (("valid", f.valid_date), ("test", f.test_date))
        ]
    )
    own = F.filter(parts, lambda p: p["date"] == F.col("snapshot_date"))
    return table.select("*", F.explode(own).alias("_p")).select(*table.columns, "_p.fold_id", "_p.split")


def fold_sizes(table: DataFrame, folds: Sequence[Fold]) -> DataFrame:
    """Train, validation and test rows per fold, from one count per date."""
    counts = {r.snapshot_date: r["n"] for r in table.groupBy("snapshot_date").agg(F.count("*").alias("n")).collect()}
    rows = [
        (
            f.fold_id,
            len(f.train_dates),
            sum(counts.get(d, 0) for d in f.train_dates),
            counts.get(f.valid_date, 0),
            counts.get(f.test_date, 0),
            f.valid_date.isoformat(),
            f.test_date.isoformat(),
        )
        for f in folds
    ]
    schema = (
        "fold_id int, train_snapshot_count int, train_rows bigint, valid_rows bigint, test_rows bigint, "
        "valid_snapshot_date string, test_snapshot_date string"
    )
    return table.sparkSession.createDataFrame(rows, schema)


def fold_results(metrics: DataFrame, sizes: DataFrame) -> DataFrame:
    """Metrics per fold, model and split with the fold's dates and row counts."""
    date = F.when(F.col("split") == "valid", F.col("valid_snapshot_date")).otherwise(F.col("test_snapshot_date"))
    keys = ["fold_id", "model", "split"]
    measured = [c for c in metrics.columns if c not in keys]
    described = [c for c in sizes.columns if c != "fold_id"]
    return (
        metrics.join(sizes, "fold_id")
        .select(*keys, *described, date.alias("snapshot_date"), *measured)
        .orderBy("model", "fold_id", "split")
    )


def backtest_summary(results: DataFrame) -> DataFrame:
    """Mean and sample deviation over folds per model and split; one fold has no deviation (NULL)."""

    def deviation(column: str):
        return F.when(F.count(column) > 1, F.stddev_samp(column)).alias(f"{column}_std")

    spread = [c for name in ("auc", "pr_auc", "f1") for c in (F.avg(name).alias(f"{name}_mean"), deviation(name))]
    return (
        results.groupBy("model", "split")
        .agg(
            F.count_distinct("fold_id").alias("folds"),
            *spread,
            F.avg("top_10pct_churn_recall").alias("top_10pct_churn_recall_mean"),
            F.avg("positive_rate").alias("positive_rate_mean"),
        )
        .orderBy(F.asc("split"), F.desc("pr_auc_mean"), F.desc("auc_mean"))
    )


def base_rates(table: DataFrame) -> DataFrame:
    """Rows, churners and churn rate per snapshot."""
    return table.groupBy("snapshot_date").agg(
        F.count("*").alias("cohort_size"),
        F.sum("churn").alias("churned"),
        ratio_or_null(F.sum("churn"), F.count("*")).alias("churn_rate"),
    )
