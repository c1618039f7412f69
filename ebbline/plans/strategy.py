"""Strategy and return analysis of one model from its validation and test predictions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.operators import strategy as ops
from ebbline.operators.comparison import choose_best_model
from ebbline.operators.metrics import Scored
from ebbline.operators.roi import best_strategies, roi_simulation
from ebbline.session import stage
from ebbline.sources.results import METRICS_SCHEMA, PREDICTION_SCHEMA, read_csv, write_csv, write_record


@dataclass(frozen=True)
class StrategyAnalysis:
    best_threshold: float
    valid_sweep: DataFrame
    test_sweep: DataFrame
    threshold_summary: DataFrame
    valid: Scored
    test: Scored

    @cached_property
    def valid_top_k(self) -> DataFrame:
        return ops.top_k_strategy(self.valid)

    @cached_property
    def test_top_k(self) -> DataFrame:
        return ops.top_k_strategy(self.test)


def run_strategy_analysis(valid: DataFrame, test: DataFrame) -> StrategyAnalysis:
    """Thresholds and the best of them come from validation; test is only measured at them."""
    valid_scored, test_scored = Scored(valid), Scored(test)
    thresholds = ops.threshold_candidates(valid_scored)
    valid_sweep = stage(ops.threshold_sweep(valid_scored, thresholds), "valid-sweep")
    test_sweep = stage(ops.threshold_sweep(test_scored, thresholds), "test-sweep")
    chosen = ops.best_threshold(valid_sweep).first().threshold
    return StrategyAnalysis(
        chosen,
        valid_sweep,
        test_sweep,
        ops.threshold_summary(test_sweep, chosen),
        valid_scored,
        test_scored,
    )


def run_roi_simulation(analysis: StrategyAnalysis, preset: str = "default") -> tuple[DataFrame, DataFrame]:
    roi = roi_simulation(analysis.test_top_k, analysis.threshold_summary, preset)
    return roi, best_strategies(roi)


def write_strategy(analysis: StrategyAnalysis, output: str, preset: str = "default") -> None:
    roi, best = run_roi_simulation(analysis, preset)
    suffix = "" if preset == "default" else f"_{preset}"
    for name, frame in {
        "valid_threshold_sweep": analysis.valid_sweep.orderBy("threshold"),
        "test_threshold_sweep": analysis.test_sweep.orderBy("threshold"),
        "threshold_strategy_summary": analysis.threshold_summary,
        "valid_topk_strategy": analysis.valid_top_k,
        "test_topk_strategy": analysis.test_top_k,
        f"roi_simulation{suffix}": roi,
        f"roi_summary{suffix}": best,
    }.items():
        write_csv(frame, f"{output}/{name}")


def analyse_stored_run(spark: SparkSession, folder: str, preset: str = "default") -> StrategyAnalysis:
    """Strategy analysis of a finished training run from its files: the best model by the stored metrics, its stored
    predictions; results and a summary record are written beside them."""
    best = choose_best_model(read_csv(spark, f"{folder}/metrics", METRICS_SCHEMA)).first()
    parts = [read_csv(spark, f"{folder}/{best.model}_{s}_predictions", PREDICTION_SCHEMA) for s in ("valid", "test")]
    analysis = run_strategy_analysis(*[stage(part, "predictions") for part in parts])
    write_strategy(analysis, folder, preset)
    summary = analysis.threshold_summary.filter("strategy = 'threshold_f1_opt'").select("targeted_users", "precision", "recall", "f1")
    record = summary.withColumns(
        {"model": F.lit(best.model), "valid_pr_auc": F.lit(best.pr_auc), "best_threshold": F.lit(analysis.best_threshold)}
    )
    write_record(record, f"{folder}/strategy_summary")
    return analysis
