"""Stored runs, and the two ways to choose a model."""

import pytest
from pyspark.sql import functions as F

from ebbline.operators.comparison import choose_best_model, first_best_model
from ebbline.sources import results
from ebbline.sources.runs import read_runs, write_run


def metric_rows(spark, rows):
    """(model, split, pr_auc, auc, f1)"""
    full = [(m, s, auc, ap, 0.5, 0.5, f1, 0.1, 0.2) for m, s, ap, auc, f1 in rows]
    return spark.createDataFrame(full, results.METRICS_SCHEMA)


def record(spark, cohort, n):
    row = ("events", 10, 3, [1, 3], 3, None, None, 6, n, 100, cohort, f"detail, with a comma, of {cohort}", "rule", "a \"rule\"")
    return spark.createDataFrame([row], results.RUN_RECORD_SCHEMA)


def test_two_orders_of_choice(spark):
    rows = [("random_forest", "valid", 0.7, 0.8, 0.9), ("logistic_regression", "valid", 0.7, 0.6, 0.99), ("boosted_balanced", "valid", 0.7, 0.8, 0.95), ("other", "test", 0.9, 0.9, 0.9), ("odd", "valid", None, None, 0.0)]
    metrics = metric_rows(spark, rows)
    assert first_best_model(metrics).first().model == "logistic_regression"  # the first of equal average precision
    assert choose_best_model(metrics).first().model == "boosted_balanced"  # then ROC-AUC, then F1
    assert choose_best_model(metrics.filter("model = 'odd'")).first().model == "odd"


def test_runs_are_read_back_and_compared(spark, tmp_path):
    root = str(tmp_path / "runs")
    names = ["a run", "b+c", "plain_1"]
    for k, name in enumerate(names):
        metrics = metric_rows(spark, [("random_forest", "valid", 0.5, 0.6, 0.1 * k), ("logistic_regression", "valid", 0.5, 0.6 + 0.1 * (k == 1), 0.15), ("random_forest", "test", 0.9, 0.9, 0.9)])
        write_run(root, name, record(spark, name, 10 + k), metrics, metric_rows(spark, [("random_forest", "test_refit", 0.25, 0.125, 1 / 3)]))
    rows = {r.prefix: r for r in read_runs(spark, root).compare().collect()}
    assert sorted(rows) == sorted(names)
    assert [rows[n].best_valid_model for n in names] == ["logistic_regression", "logistic_regression", "random_forest"]
    assert all(rows[n].active_user_definition_detail == f"detail, with a comma, of {n}" and rows[n].row_count == 10 + k for k, n in enumerate(names))
    assert rows["b+c"].test_refit_f1 == 1 / 3 and rows["b+c"].valid_auc == 0.7
    assert read_runs(spark, root, ["plain_1"]).compare().count() == 1
    with pytest.raises(ValueError, match="absent"):
        read_runs(spark, root, ["plain_1", "absent"])
    record(spark, "half", 1).write.json(f"{root}/half/record")
    with pytest.raises(ValueError, match="half"):
        read_runs(spark, root)


def test_one_file_read_per_kind(spark, tmp_path):
    root = str(tmp_path / "runs")
    for name in ("x", "y"):
        write_run(root, name, record(spark, name, 1), metric_rows(spark, [("m", "valid", 0.5, 0.5, 0.5)]), metric_rows(spark, [("m", "test_refit", 0.5, 0.5, 0.5)]))
    runs = read_runs(spark, root)
    assert runs.metrics._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert runs.metrics.filter(F.col("prefix") == "y").count() == 1
