"""Training, backtest and strategy plans end to end with small ensembles."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from ebbline import catalog
from ebbline.catalog import STREAM_CONFIG, stream_table
from ebbline.operators.comparison import compare_runs
from ebbline.plans import models as models_module
from ebbline.plans.backtest import run_rolling_backtest
from ebbline.plans.ensembles import bootstrap_class_counts, leaf_residuals, with_draws
from ebbline.plans.feature_table import run_record
from ebbline.plans.models import FAST, LEAF_PENALTY, ROW_CAPS, STEP, Effort, feature_importance, assembled, feature_names, fit, linear_coefficients, logistic_gradient, score, train_and_evaluate
from ebbline.plans.strategy import run_roi_simulation, run_strategy_analysis, write_strategy
from ebbline.session import stage
from ebbline.sources import results
from pyspark.sql import functions as F

TINY = Effort(trees=3, rounds=2, forest_depth=3, boost_depth=2, iterations=10)


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    return stream_table(spark, sf_dir)


@pytest.fixture(scope="module")
def table(built):
    return stage(built.frame, "features")


def test_training_run_and_its_files(spark, built, table, tmp_path):
    out = str(tmp_path / "run")
    models = ("random_forest", "boosted_balanced")
    run = train_and_evaluate(table, STREAM_CONFIG, models, TINY, out)
    rows = run.metrics.collect()
    assert {(r.model, r.split) for r in rows} == {(m, s) for m in models for s in ("valid", "test")}
    assert all(0 <= r.auc <= 1 and 0 <= r.pr_auc <= 1 for r in rows)
    best = max((r for r in rows if r.split == "valid"), key=lambda r: (r.pr_auc, r.auc, r.f1))
    assert run.best_model == best.model
    assert [r.split for r in run.refit_metrics.collect()] == ["test_refit"]
    assert run.refit_importance.count() == 50

    predictions = {
        s: results.read_csv(spark, f"{out}/{run.best_model}_{s}_predictions", results.PREDICTION_SCHEMA)
        for s in ("valid", "test")
    }
    assert predictions["test"].count() == table.filter("split = 'test'").count()
    analysis = run_strategy_analysis(predictions["valid"], predictions["test"])
    roi, top = run_roi_simulation(analysis, "realistic_ecommerce")
    assert roi.count() == 3 * (5 + analysis.threshold_summary.count()) and top.count() == 9
    write_strategy(analysis, f"{out}/strategy")

    metrics = results.read_csv(spark, f"{out}/metrics", results.METRICS_SCHEMA).withColumn("prefix", F.lit("a"))
    refit = results.read_csv(spark, f"{out}/best_model_test_metrics", results.METRICS_SCHEMA).withColumn("prefix", F.lit("a"))
    record = run_record(spark, built, "events").withColumn("prefix", F.lit("a"))
    compared = compare_runs(record, metrics, refit).first()
    assert compared.best_valid_model == compared.test_refit_model == run.best_model
    assert compared.row_count == table.count()


def test_feature_names_hold_no_label(table):
    names = feature_names(table, STREAM_CONFIG)
    assert len(names) == len(table.columns) - 6
    assert not {"churn", "split", "client_id", "snapshot_date"} & set(names)
    assert not [n for n in names if n.startswith("future_")]


def test_linear_model_is_fitted_in_few_partitions(table, monkeypatch):
    """The partitions that the optimiser passes over follow the rows it fits, not the files of the table."""
    names, seen, real = feature_names(table, STREAM_CONFIG), [], models_module.few_partitions
    train = table.filter("split = 'train'").repartition(40)
    n_rows = train.count()
    monkeypatch.setattr(models_module, "FIT_ROWS", n_rows - 1)
    monkeypatch.setattr(models_module, "few_partitions", lambda *a: seen.append(real(*a)) or seen[-1])
    fitted = fit(train, "logistic_regression", names, effort=TINY)
    assert [(rows.rdd.getNumPartitions(), rows.count()) for rows in seen] == [(2, n_rows)]
    assert len(linear_coefficients(fitted)) == len(names) + 1


@pytest.mark.parametrize("model", sorted(ROW_CAPS))
def test_every_model_scores_probabilities(table, model):
    names = feature_names(table, STREAM_CONFIG)
    fitted = fit(table.filter("split = 'train'"), model, names, effort=TINY)
    scored = score(fitted, table.filter("split = 'test'"), names, ("split",))
    low, high = scored.selectExpr("min(y_score)", "max(y_score)").first()
    assert 0 <= low < high <= 1 and scored.columns[-1] == "split"


def test_linear_importance_is_absolute(spark, table):
    names = feature_names(table, STREAM_CONFIG)
    fitted = fit(table.filter("split = 'train'"), "logistic_regression", names, effort=FAST)
    values = [r.importance for r in feature_importance(spark, fitted, names, 10).collect()]
    assert len(values) == 10 and values == sorted(values, reverse=True) and min(values) >= 0


def test_backtest(table):
    measured, summary = run_rolling_backtest(table, STREAM_CONFIG, ("logistic_regression",), effort=TINY)
    rows = measured.collect()
    assert [(r.fold_id, r.split) for r in rows] == [(1, "test"), (1, "valid"), (2, "test"), (2, "valid")]
    assert all(r.train_rows > 0 and r.valid_snapshot_date < r.test_snapshot_date for r in rows)
    assert {r.folds for r in summary.collect()} == {2}
    with pytest.raises(ValueError):
        run_rolling_backtest(table, STREAM_CONFIG, ("oracle",))


def test_fits_side_by_side_equal_fits_in_turn(table, monkeypatch):
    """The same metrics from one thread and from four; the vectors are assembled once."""
    from ebbline.plans import backtest

    calls = []
    once = backtest.assembled
    monkeypatch.setattr(backtest, "assembled", lambda *args: calls.append(1) or once(*args))
    models = ("logistic_regression", "random_forest", "boosted_balanced")
    one, four = (backtest.run_rolling_backtest(table, STREAM_CONFIG, models, effort=TINY, threads=n)[0] for n in (1, 4))
    assert len(calls) == 2

    def key(r):
        return r.fold_id, r.model, r.split

    for a, b in zip(sorted(one.collect(), key=key), sorted(four.collect(), key=key), strict=True):
        assert key(a) == key(b) and a.train_rows == b.train_rows
        assert a.auc == pytest.approx(b.auc, abs=1e-6) and a.pr_auc == pytest.approx(b.pr_auc, abs=1e-6)


def test_an_error_in_a_thread_is_raised(spark):
    from ebbline.plans.threads import concurrently

    assert concurrently(spark, {"a": lambda: spark.range(3).count(), "b": lambda: 2}) == {"a": 3, "b": 2}
    with pytest.raises(ZeroDivisionError):
        concurrently(spark, {"a": lambda: 1 / 0, "b": lambda: 2})
    assert concurrently(spark, {}) == {}


def test_linear_model_is_at_its_minimum(table):
    """The gradient is small at the optimum and not after a few steps; the intercept is a penalised coefficient."""
    train = table.filter("split = 'train'")
    names = feature_names(table, STREAM_CONFIG)
    norms = []
    for effort in (Effort(iterations=3), Effort()):
        fitted = fit(train, "logistic_regression", names, effort=effort)
        rows = logistic_gradient(fitted, train, names).collect()
        assert len(rows) == len(names) + 1 and fitted.stages[-1].intercept == 0
        norms.append(max(abs(r.gradient) for r in rows))
    assert norms[1] < 1e-5 < norms[0]
    # turned back, the coefficients score scaled features and a constant
    rows = PipelineModel(fitted.stages[1:-1]).transform(assembled(train, names)).limit(50)
    beta = linear_coefficients(fitted)
    for r in fitted.stages[-1].transform(rows).collect():
        z = float(np.dot(beta[:-1], r.scaled.toArray()) + beta[-1])
        assert r.probability[1] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def small_rows(spark):
    return spark.range(200).selectExpr(
        "id AS client_id", "DATE'2024-01-01' AS snapshot_date", "IF(id < 160, 'train', 'test') AS split",
        "int(id % 3 = 0) AS churn", "double(id % 7) AS a", "double(id * id % 11) AS b",
    )


def test_linear_optimality_is_of_all_training_rows(spark, monkeypatch):
    """The fit takes every training row that the gradient is taken over, also where the models' runs are capped."""
    monkeypatch.setattr(catalog, "_stored_table", lambda *_: small_rows(spark))
    monkeypatch.setitem(ROW_CAPS, "logistic_regression", 50)
    found = catalog.logistic_optimality(spark, "")
    assert [r.asDict() for r in found.collect()] == [{"n_coefficients": 3, "optimal": True, "n_rows": 160, "positives": 54}]


def test_newton_steps_end_at_the_minimum(spark, tmp_path):
    """From an optimiser that spent its iterations; one that ended before its limit is left alone."""
    train, names = small_rows(spark).filter("split = 'train'"), ["a", "b"]
    norms = []
    for effort in (Effort(iterations=1), Effort(iterations=1, newton=6)):
        fitted = fit(train, "logistic_regression", names, effort=effort)
        norms.append(max(abs(r.gradient) for r in logistic_gradient(fitted, train, names).collect()))
    assert norms[1] < 1e-8 and norms[0] > 1e-4 and fitted.stages[-1].intercept == 0
    path = str(tmp_path / "linear")
    results.save_model(fitted, path)
    own, loaded = ({r.client_id: r.y_score for r in score(m, train, names).collect()} for m in (fitted, PipelineModel.load(path)))
    assert len(own) == 160 and own == loaded
    ended = [linear_coefficients(fit(train, "logistic_regression", names, effort=e)) for e in (Effort(), Effort(newton=6))]
    assert ended[0] == pytest.approx(ended[1], abs=1e-14)
    assert ended[0] == pytest.approx(linear_coefficients(fitted), abs=1e-4)


def test_draws_follow_the_poisson_law(spark):
    """Shares of 0, 1, 2, ... draws, other draws in other bootstraps, and classes of equal weight in each."""
    rows = spark.range(20_000).selectExpr("id AS client_id", "DATE'2024-01-01' AS snapshot_date", "int(id % 10 = 0) AS churn")
    drawn = with_draws(rows, 2, 42)
    shares = {r.n: r["count"] / 20_000 for r in drawn.groupBy(F.col("draws")[0].alias("n")).count().collect()}
    for k, share in enumerate((0.3679, 0.3679, 0.1839, 0.0613)):
        assert shares[k] == pytest.approx(share, abs=0.015)
    together = drawn.selectExpr("corr(draws[0], draws[1])").first()[0]
    assert abs(together) < 0.03
    sums = [r.n_draws * r.class_weight for r in bootstrap_class_counts(drawn).collect()]
    assert len(sums) == 4 and sums[0] > 9_000
    per_part = {(r.part, round(r.n_draws * r.class_weight, 6)) for r in bootstrap_class_counts(drawn).collect()}
    assert len(per_part) == 2


def test_forest_of_bootstraps_is_the_mean_of_its_parts(table, tmp_path):
    names = feature_names(table, STREAM_CONFIG)
    train, test = (assembled(table.filter(f"split = '{s}'"), names) for s in ("train", "test"))
    fitted = fit(train, "random_forest", names, effort=Effort(trees=5, bootstraps=2, forest_depth=3))
    parts = fitted.stages[1:-1]
    assert [p.getNumTrees for p in parts] == [3, 2]
    expected = {}
    for part in parts:
        for r in part.transform(test).collect():
            key = (r.client_id, r.snapshot_date)
            expected[key] = expected.get(key, 0.0) + r[part.getProbabilityCol()][1] * part.getNumTrees / 5
    path = str(tmp_path / "forest")
    results.save_model(fitted, path)
    for model in (fitted, PipelineModel.load(path)):
        scored = {(r.client_id, r.snapshot_date): r.y_score for r in score(model, test, names).collect()}
        assert scored == pytest.approx(expected, abs=1e-12)
    again = fit(train.repartition(5), "random_forest", names, effort=Effort(trees=5, bootstraps=2, forest_depth=3))
    assert [p.numFeatures for p in again.stages[1:-1]] == [p.numFeatures for p in parts]


def test_boosted_leaves_are_penalised(table, tmp_path):
    """Leaf values tree by tree against numpy, from the leaves that the fitted trees put the rows in."""
    names = feature_names(table, STREAM_CONFIG)
    train = assembled(table.filter("split = 'train'"), names)
    fitted = fit(train, "boosted_subsampled", names, effort=Effort(rounds=4, boost_depth=3))
    boosted, scores = fitted.stages[1:]
    rows = boosted.transform(train).collect()
    leaves = np.array([r.leaves.toArray().astype(int) for r in rows])
    churn = np.array([float(r.churn) for r in rows])
    width = scores.getOrDefault(scores.width)
    values = np.array(scores.getOrDefault(scores.values)).reshape(4, width)
    margin = np.zeros(len(rows))
    for tree in range(4):
        p = 1 / (1 + np.exp(-margin))
        for leaf in range(width):
            at = leaves[:, tree] == leaf
            want = STEP * (churn - p)[at].sum() / ((p * (1 - p))[at].sum() + LEAF_PENALTY)
            assert values[tree, leaf] == pytest.approx(want, abs=1e-9)
        margin += values[tree, leaves[:, tree]]
    assert sorted(r.y_score for r in score(fitted, train, names).collect()) == pytest.approx(sorted(1 / (1 + np.exp(-margin))))
    path = str(tmp_path / "boosted")
    results.save_model(fitted, path)
    loaded = score(PipelineModel.load(path), train, names)
    assert sorted(r.y_score for r in loaded.collect()) == pytest.approx(sorted(1 / (1 + np.exp(-margin))))
    residuals = leaf_residuals(fitted.stages[1:], train, STEP, LEAF_PENALTY).collect()
    assert sorted(r.tree for r in residuals) == [0, 1, 2, 3] and max(r.residual for r in residuals) < 1e-9
    assert {r.n_rows for r in residuals} == {len(rows)}
