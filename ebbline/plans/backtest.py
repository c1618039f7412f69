"""Rolling backtest: one fit per fold and model, several at a time, and one grouped evaluation of all folds."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.config import ChurnConfig
from ebbline.operators.folds import Fold, backtest_summary, fold_results, fold_sizes, rolling_folds
from ebbline.operators.metrics import binary_metrics
from ebbline.operators.snapshots import present_dates
from ebbline.plans.models import FULL, ROW_CAPS, Effort, assembled, feature_names, fit, score
from ebbline.plans.threads import THREADS, concurrently
from ebbline.session import stage
from ebbline.sources.results import write_csv


def run_rolling_backtest(
    table: DataFrame,
    cfg: ChurnConfig,
    models: tuple[str, ...] = tuple(ROW_CAPS),
    min_train: int = 3,
    effort: Effort = FULL,
    output: str | None = None,
    caps: dict[str, int] = ROW_CAPS,
    threads: int = THREADS,
) -> tuple[DataFrame, DataFrame]:
    """Results per fold, model and split, and their summary; both are written below ``output`` if it is given.
    The features are assembled and stored once."""
    unknown = [m for m in models if m not in ROW_CAPS]
    if unknown:
        raise ValueError(f"unknown model(s): {unknown}")
    names = feature_names(table, cfg)
    folds = rolling_folds(present_dates(table), min_train)
    vectors = stage(assembled(table, names), "assembled")  # once for all folds and models

    def fold_scores(fold: Fold, model: str) -> DataFrame:
        train = vectors.filter(F.col("snapshot_date").isin(list(fold.train_dates)))
        held_out = vectors.filter(F.col("snapshot_date").isin([fold.valid_date, fold.test_date]))
        split = F.when(F.col("snapshot_date") == F.lit(fold.valid_date), "valid").otherwise("test")
        fitted = fit(train, model, names, cfg.seed, effort, caps)
        return score(fitted, held_out, names).withColumns({"fold_id": F.lit(fold.fold_id), "model": F.lit(model), "split": split})

    jobs = {(fold.fold_id, model): partial(fold_scores, fold, model) for fold in folds for model in models}
    scored = list(concurrently(table.sparkSession, jobs, threads).values())
    predictions = stage(reduce(DataFrame.unionByName, scored), "fold-predictions")
    metrics = binary_metrics(predictions, ("fold_id", "model", "split"))
    measured = stage(fold_results(metrics, fold_sizes(table, folds)), "fold-metrics")
    summary = backtest_summary(measured)
    if output:
        write_csv(measured.orderBy("model", "fold_id", "split"), f"{output}/rolling_backtest_results")
        write_csv(summary, f"{output}/rolling_backtest_summary")
    return measured.orderBy("model", "fold_id", "split"), summary
