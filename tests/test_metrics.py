"""Ranks, metrics, sweeps, caps and folds against brute force, small path and bucketed path."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.operators import errors, folds, profiling, ranking, roi, sampling, strategy
from ebbline.operators.comparison import choose_best_model
from ebbline.operators.metrics import Scored, binary_metrics, prediction_frame
from ebbline.operators.ranking import CELL_ROWS, FINE_CELLS, By, cell_count, in_cells, row_numbers, running_totals

D = dt.date(2024, 1, 1)
SCHEMA = "client_id long, snapshot_date date, y_true int, y_score double, g string"


def scores(kind: str, n: int = 400, seed: int = 1):
    rng = random.Random(seed)
    value = {
        "smooth": rng.random,
        "ties": lambda: rng.choice([0.1, 0.5, 0.5, 0.5, 0.9]),
        "equal": lambda: 0.5,
        "narrow": lambda: 0.5 + rng.random() * 1e-12,
    }[kind]
    out = []
    for i in range(n):
        s = value()
        out.append((i // 3, D + dt.timedelta(days=i % 3), int(rng.random() < 0.2 + 0.5 * s), s, rng.choice("ab")))
    rng.shuffle(out)
    return out


def naive(rows, threshold=0.5, share=0.1):
    pos, neg = [r[3] for r in rows if r[2]], [r[3] for r in rows if not r[2]]
    auc = None
    if pos and neg:
        auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0
    for s in sorted({r[3] for r in rows}, reverse=True):
        above = [r for r in rows if r[3] >= s]
        hits = sum(r[2] for r in above)
        ap += (hits - seen) / max(len(pos), 1) * hits / len(above)
        seen = hits
    chosen = [r for r in rows if r[3] >= threshold]
    tp = sum(r[2] for r in chosen)
    p, r_ = (tp / len(chosen) if chosen else 0.0), (tp / len(pos) if pos else 0.0)
    top = sorted(rows, key=lambda r: (-r[3], r[0], r[1]))[: max(1, int(len(rows) * share))]
    return {
        "auc": auc,
        "pr_auc": ap,
        "precision": p,
        "recall": r_,
        "f1": 2 * p * r_ / (p + r_) if p + r_ else 0.0,
        "top_10pct_churn_recall": sum(r[2] for r in top) / max(len(pos), 1),
        "positive_rate": len(pos) / len(rows),
    }


def assert_metrics(row, expected):
    for name, value in expected.items():
        assert (row[name] is None) if value is None else row[name] == pytest.approx(value, abs=1e-12), name


@pytest.mark.parametrize("kind", ["smooth", "ties", "equal", "narrow"])
@pytest.mark.parametrize("bucket_rows", [10, 500_000])
def test_metrics(spark, kind, bucket_rows):
    rows = scores(kind)
    df = spark.createDataFrame(rows, SCHEMA)
    assert_metrics(Scored(df, (), bucket_rows).metrics().first(), naive(rows))
    for r in Scored(df, ["g"], bucket_rows).metrics().collect():
        assert_metrics(r, naive([x for x in rows if x[4] == r.g]))


@pytest.mark.parametrize("labels", [[0], [1], [0, 0, 0], [1, 0]])
def test_tiny_and_one_class(spark, labels):
    rows = [(i, D, y, 0.25 * i, "a") for i, y in enumerate(labels)]
    assert_metrics(binary_metrics(spark.createDataFrame(rows, SCHEMA)).first(), naive(rows))


def test_auc_of_reversed_scores(spark):
    df = spark.createDataFrame(scores("ties"), SCHEMA)
    reverse = df.withColumn("y_score", 1 - F.col("y_score"))
    assert binary_metrics(df).first().auc + binary_metrics(reverse).first().auc == pytest.approx(1)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("kind", ["smooth", "ties", "equal"])
def test_bucketed_ranks_equal_plain_ranks(spark, kind, descending):
    df = spark.createDataFrame(scores(kind, 500), SCHEMA).withColumn("_day", F.unix_date("snapshot_date"))
    order = [By("y_score", descending), By("client_id", descending), By("_day")]
    for group in ((), ("g",)):
        keys = ["client_id", "_day", "rank"]
        plain = row_numbers(df, order, group).select(keys).collect()
        bucketed = row_numbers(df, order, group, bucket_rows=7)
        assert sorted(plain) == sorted(bucketed.select(keys).collect())
    cells = bucketed.count()
    assert cells == 500


def test_small_cells_stay_few(spark):
    """The number of cells, each a partition, does not follow the rows of a large table when cells are wished small."""
    assert cell_count(6_000_000, 20) == FINE_CELLS and cell_count(400, 20) == 20
    assert cell_count(1000 * CELL_ROWS, 20) == cell_count(1000 * CELL_ROWS, CELL_ROWS) == 1000
    df = spark.range(4 * FINE_CELLS).selectExpr("id AS k", "id % 3 AS v")
    assert in_cells(df, [By("v"), By("k")], (), 1).select("_cell").distinct().count() <= FINE_CELLS
    ranked = row_numbers(df, [By("v"), By("k")], (), "place", bucket_rows=1).collect()
    assert [r.k for r in sorted(ranked, key=lambda r: r.place)] == sorted(range(4 * FINE_CELLS), key=lambda k: (k % 3, k))


def test_segments_in_few_cells(spark, monkeypatch):
    """Segments wished in tiny cells are ranked in FINE_CELLS cells at most and stay the same."""
    made = []
    real = ranking.cell_count
    monkeypatch.setattr(ranking, "cell_count", lambda *a: made.append(real(*a)) or made[-1])
    df = spark.range(2 * FINE_CELLS).selectExpr("id AS client_id", "DATE '2024-01-01' AS snapshot_date", "id % 11 AS v")
    fine, coarse = (errors.value_segments(df, "v", rows).select("client_id", "value_segment") for rows in (1, CELL_ROWS))
    assert made == [FINE_CELLS, ranking.MIN_CELLS]
    assert sorted(map(tuple, fine.collect())) == sorted(map(tuple, coarse.collect()))


def test_running_totals_of_values(spark):
    df = spark.createDataFrame([(float(i % 17), i, i) for i in range(200)], "x double, k long, v long")
    got = running_totals(df, {"cum": "v"}, [By("x"), By("k")], bucket_rows=9).collect()
    total = 0
    for r in sorted(got, key=lambda r: (r.x, r.k)):
        total += r.v
        assert r.cum == total


@pytest.mark.parametrize("kind", ["smooth", "ties", "equal"])
def test_quantiles_and_sweep(spark, kind):
    rows = scores(kind, 203)
    scored = Scored(spark.createDataFrame(rows, SCHEMA), (), 20)
    values = [r[3] for r in rows]
    probs = [0.5, 0.6, 0.75, 0.975, 0.99]
    assert strategy.score_quantiles(scored, probs) == pytest.approx(list(np.quantile(values, probs)))
    sweep = strategy.threshold_sweep(scored).collect()
    targeted = [r.targeted_users for r in sweep]
    assert targeted == sorted(targeted, reverse=True)
    for r in sweep:
        assert r.targeted_users == sum(v >= r.threshold for v in values)
        assert_metrics(r, naive(rows, r.threshold))


def test_best_threshold_prefers_the_higher_one(spark):
    rows = [(0.2, 0.5, 0.5, 0.5), (0.3, 0.5, 0.5, 0.5), (0.1, 0.4, 1.0, 0.9)]
    sweep = spark.createDataFrame(rows, "threshold double, f1 double, recall double, precision double")
    assert strategy.best_threshold(sweep).first().threshold == 0.3


@pytest.mark.parametrize("kind", ["smooth", "ties"])
def test_top_k(spark, kind):
    rows = scores(kind, 333)
    ranked = sorted(rows, key=lambda r: (-r[3], r[0], r[1]))
    positives = sum(r[2] for r in rows)
    table = strategy.top_k_strategy(Scored(spark.createDataFrame(rows, SCHEMA), (), 20), [0.001, 0.05, 0.2, 1.0])
    for r in table.collect():
        top = ranked[: max(1, int(len(rows) * r.top_k_pct))]
        hits = sum(x[2] for x in top)
        assert (r.targeted_users, r.captured_churn_users) == (len(top), hits)
        assert r.avg_score == pytest.approx(sum(x[3] for x in top) / len(top))
        assert r.lift_vs_base == pytest.approx(hits / len(top) / (positives / len(rows)))
    whole = table.filter("top_k_pct = 1").first()
    assert whole.churn_recall == 1 and whole.lift_vs_base == pytest.approx(1)


def test_roi_identities_and_edges(spark):
    strategies = spark.createDataFrame(
        [("top_k", "top_10pct", 0.1, 100, 0.8), ("top_k", "none", 0.0, 0, 0.0)],
        "strategy_kind string, strategy_label string, strategy_value double, targeted_users long, churn_precision double",
    )
    scenarios = [*roi.scenarios_of("default"), roi.Scenario("loss", 0.5, 20.0, 10.0, 0.1), roi.Scenario("free", 0, 0, 1, 1)]
    for r in roi.expected_roi(strategies, scenarios).collect():
        cost = r.expected_contact_cost + r.expected_incentive_cost
        assert r.expected_total_cost == pytest.approx(cost)
        assert r.expected_net_profit == pytest.approx(r.expected_gross_profit - cost)
        assert (r.expected_roi is None) if cost <= 0 else r.expected_roi == pytest.approx(r.expected_net_profit / cost)
        margin = max(r.gross_profit_per_saved_user - r.incentive_cost_per_saved_user, 1e-9)
        assert r.break_even_saved_users == pytest.approx(r.expected_contact_cost / margin)
    best = roi.best_strategies(roi.expected_roi(strategies, scenarios), 1).collect()
    assert len(best) == len(scenarios)
    with pytest.raises(ValueError):
        roi.scenarios_of("unknown")


@pytest.mark.parametrize("bucket_rows", [3, 1000])
def test_value_segments(spark, bucket_rows):
    rows = [(i, D, 10 - i) for i in range(10)] + [(50, D, None)]
    df = spark.createDataFrame(rows, "client_id long, snapshot_date date, v long")
    got = errors.value_segments(df, "v", bucket_rows).groupBy("value_segment").count().collect()
    assert dict(got) == {"low": 3, "mid_low": 2, "mid_high": 2, "high": 3, "unknown": 1}
    same = errors.value_segments(df.withColumn("v", F.lit(1)), "v", bucket_rows)
    assert [r[0] for r in same.select("value_segment").distinct().collect()] == ["unknown"]
    two = errors.value_segments(df.filter("v IS NOT NULL").withColumn("v", F.expr("v % 2")), "v", bucket_rows)
    assert dict(two.groupBy("value_segment").count().collect()) == {"low": 5, "mid_low": 5}


def test_error_types(spark):
    rows = [(1, D, 1, 0.4, "a"), (2, D, 0, 0.5, "a"), (3, D, 1, 0.5, "a"), (4, D, 0, 0.1, "a")]
    frame = prediction_frame(spark.createDataFrame(rows, SCHEMA)).orderBy("client_id")
    kinds = [r.error_type for r in frame.collect()]
    assert kinds == ["false_negative", "false_positive", "correct", "correct"]
    assert errors.worst_cases(frame, "false_positive", 5).count() == 1
    assert errors.error_feature_means(frame.filter("client_id > 2"), "false_positive").count() == 0


@pytest.mark.parametrize("bucket_rows", [11, 100_000])
def test_stratified_cap(spark, bucket_rows):
    rows = [(i, D, int(i % 10 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "client_id long, snapshot_date date, churn int")
    kept = sampling.cap_rows(df, 50, bucket_rows=bucket_rows).collect()
    assert len(kept) == len(set(kept)) == 50 and sum(r.churn for r in kept) == 5
    again = sampling.cap_rows(df.repartition(7), 50, bucket_rows=13).collect()
    assert sorted(kept) == sorted(again)
    assert sampling.cap_rows(df, 1000).count() == 300
    odd = sampling.cap_rows(df.filter("client_id < 15"), 7).count()
    assert odd == 7


def test_class_quotas():
    assert sampling.class_quotas({0: 90, 1: 10}, 50) == {0: 45, 1: 5}
    assert sampling.class_quotas({0: 999, 1: 1}, 10) == {0: 10}
    assert sampling.class_quotas({0: 1, 1: 999}, 10) == {0: 1, 1: 9}


def test_folds(spark):
    dates = [D + dt.timedelta(days=i) for i in range(9)]
    found = folds.rolling_folds(dates)
    assert len(found) == 5
    for f in found:
        assert max(f.train_dates) < f.valid_date < f.test_date
    assert len(folds.rolling_folds(dates[:5])) == 1
    with pytest.raises(ValueError):
        folds.rolling_folds(dates[:4])
    table = spark.createDataFrame([(i, d) for d in dates for i in range(4)], "client_id long, snapshot_date date")
    members = folds.fold_members(table, found).groupBy("fold_id", "split").count().collect()
    assert len(members) == 10 and all(r["count"] == 4 for r in members)
    sizes = folds.fold_sizes(table, found).collect()
    assert [r.train_rows for r in sizes] == [12, 16, 20, 24, 28]


def test_backtest_summary_of_one_fold_has_no_deviation(spark):
    rows = [(1, "m", "valid", 0.5, 0.4, 0.3, 0.2, 0.1)]
    schema = "fold_id int, model string, split string, auc double, pr_auc double, f1 double, "
    df = spark.createDataFrame(rows, schema + "top_10pct_churn_recall double, positive_rate double")
    summary = folds.backtest_summary(df).first()
    assert summary.auc_std is None and summary.auc_mean == 0.5 and summary.folds == 1


def test_undefined_metrics_sort_last(spark):
    rows = [("a", "valid", None, None, 0.1), ("b", "valid", 0.6, 0.5, 0.1), ("c", "test", 0.9, 0.9, 0.9)]
    metrics = spark.createDataFrame(rows, "model string, split string, auc double, pr_auc double, f1 double")
    assert choose_best_model(metrics).first().model == "b"


def test_histogram(spark):
    values = [0, 0, 1, 5, 9, 10]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    counts = [r.n_rows for r in profiling.histogram(df, "v", 30).orderBy("bin").collect()]
    assert counts == list(np.histogram(values, bins=30)[0])
    constant = profiling.histogram(df.withColumn("v", F.lit(3)), "v", 30).orderBy("bin").collect()
    assert [r.n_rows for r in constant] == list(np.histogram([3] * 6, bins=30)[0])
    assert profiling.histogram(df.filter("v > 99"), "v").count() == 0
