"""Registered queries over the test tables: name -> callable(spark, sf_dir) -> DataFrame.

Metric queries use a fixed score (recency against frequency of buys), so that an SQL engine can check
them without a trained model. Doubles are rounded, because the order of a distributed sum is free.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.config import ALL_EVENTS, BUY, CART, COHORTS, PAGE, REMOVE, SEARCH, ChurnConfig
from ebbline.functions.scalar import parse_vector
from ebbline.operators import errors, folds, profiling, strategy
from ebbline.operators.comparison import choose_best_model
from ebbline.operators.days import client_days, daily_rollup, day_rows
from ebbline.operators.derived import funnel_columns, trend_columns
from ebbline.operators.metrics import Scored, binary_metrics, prediction_frame
from ebbline.operators.profile import definition_rates as profile_rates
from ebbline.operators.profile import project, search_days, snapshot_profile
from ebbline.operators.ranking import By, row_numbers
from ebbline.operators.sampling import cap_rows, class_counts
from ebbline.operators.snapshots import buyer_activity, dataset_bounds, grid_between, present_dates, rollup_bounds, snapshot_grid
from ebbline.plans.backtest import run_rolling_backtest
from ebbline.plans.ensembles import bootstrap_class_counts, leaf_residuals, with_draws
from ebbline.plans.feature_table import FeatureTable, assign_time_splits, build_feature_table, build_feature_tables, run_record
from ebbline.plans.models import (
    ALL_ROWS,
    FAST,
    LEAF_PENALTY,
    STEP,
    assembled,
    class_weights,
    feature_importance,
    feature_names,
    fit,
    logistic_gradient,
    train_and_evaluate,
)
from ebbline.plans.strategy import run_roi_simulation, run_strategy_analysis
from ebbline.session import shared_folder, stage
from ebbline.sources import logs, results
from ebbline.sources.bindings import (
    ORDERS_CONFIG,
    STREAM_CONFIG,
    order_activity,
    part_products,
    stream_activity,
)
from ebbline.sources.runs import read_runs, write_run

KEYS = ["snapshot_date", "client_id"]
CAP = 300
SAMPLE = 0.3


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    doubles = {name for name, dtype in df.dtypes if dtype == "double"}
    return df.select([F.round(F.col(c), digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def stream_profile(
    spark: SparkSession, sf_dir: str, cfg: ChurnConfig = STREAM_CONFIG, events=(BUY, CART, PAGE), details=()
) -> DataFrame:
    activity = stream_activity(spark, sf_dir)
    bounds = dataset_bounds(activity)
    products = part_products(spark, sf_dir)
    return snapshot_profile(day_rows(activity), grid_between(bounds, cfg), cfg, products, events, details, bounds)


def orders_profile(spark: SparkSession, sf_dir: str, details=()) -> DataFrame:
    cfg = ORDERS_CONFIG
    rollup = stage(daily_rollup(order_activity(spark, sf_dir)), "rollup")  # orders and lines are joined once
    bounds = rollup_bounds(rollup)
    grid = grid_between(bounds, cfg)
    return snapshot_profile(rollup, grid, cfg, part_products(spark, sf_dir), (BUY,), details, bounds, rolled=True)


def columns_like(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.select(*KEYS, *[c for c in df.columns if c.startswith(prefixes)])


# --- logs and days ------------------------------------------------------------------------------


def activity_daily_rollup(spark, sf_dir):
    return daily_rollup(stream_activity(spark, sf_dir))


def client_active_days(spark, sf_dir):
    return client_days(day_rows(stream_activity(spark, sf_dir)))


def clean_page_log(spark, sf_dir):
    return logs.cleaned_log(stream_activity(spark, sf_dir), PAGE)


def clean_product_table(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return logs.typed_products(
        part.selectExpr("p_partkey AS sku", "p_size AS category", "p_retailprice AS price", "p_name AS name")
    )


def client_sample(spark, sf_dir):
    sample = logs.sample_clients(stream_activity(spark, sf_dir), SAMPLE, seed=42)
    return sample.groupBy("client_id").agg(F.count("*").alias("n_events"))


def buyer_event_counts(spark, sf_dir):
    kept = buyer_activity(stream_activity(spark, sf_dir), STREAM_CONFIG)
    return kept.groupBy("event").agg(F.count("*").alias("n_events"))


def search_day_conversions(spark, sf_dir):
    days = search_days(day_rows(stream_activity(spark, sf_dir)))
    return days.selectExpr(
        "client_id",
        "day",
        "n AS search_count",
        f"CASE WHEN {CART}_0 OR {CART}_1 THEN n ELSE 0L END AS search_to_cart_1d_count",
        f"CASE WHEN {BUY}_0 OR {BUY}_1 THEN n ELSE 0L END AS search_to_buy_1d_count",
    )


def event_volume(spark, sf_dir):
    return logs.event_volume(stream_activity(spark, sf_dir))


def stored_logs(spark, sf_dir) -> str:
    """The five logs and the product table as files below a new folder."""
    root = f"{shared_folder(spark)}/ebbline/logs-{uuid.uuid4().hex}"
    activity = stream_activity(spark, sf_dir)
    for event in ALL_EVENTS:
        attribute = logs.LOG_ATTRIBUTE[event]
        raw = activity.filter(F.col("event") == event).select("client_id", F.col("ts").alias("timestamp"), attribute)
        raw.write.parquet(f"{root}/some/where/below/this/folder/{event}.parquet")
    part_products(spark, sf_dir).write.parquet(f"{root}/product_properties.parquet")
    return root


def event_volume_footers(spark, sf_dir):
    return logs.footer_volume(spark, stored_logs(spark, sf_dir))


def cleaned_logs_by_view(spark, sf_dir):
    """The strict logs through views, as SQL users see them: rows, clients, missing pages and days."""
    cleaned = logs.cleaned_logs(logs.read_activity(spark, stored_logs(spark, sf_dir)))
    logs.register_views({f"strict_{e}": df for e, df in cleaned.items()})
    return reduce(DataFrame.unionByName, [
        spark.sql(f"""SELECT '{e}' AS event, count(*) AS n_rows, count(DISTINCT client_id) AS n_clients,
          count(DISTINCT date_trunc('DAY', timestamp)) AS n_days, count({logs.LOG_ATTRIBUTE[e]}) AS n_values FROM strict_{e}""")
        for e in ALL_EVENTS
    ])


def text_times(spark, sf_dir):
    """Times as text, some of them missing and some unreadable."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = events.selectExpr("CASE WHEN event_id % 7 = 0 THEN 'no time at all' WHEN event_id % 11 <> 0 THEN CAST(ts AS STRING) END AS timestamp")
    return logs.time_quality(text)


# --- snapshots, cohorts, labels -----------------------------------------------------------------


def time_bounds(spark, sf_dir):
    return dataset_bounds(stream_activity(spark, sf_dir)).frame(spark)


def grid_dates(spark, sf_dir):
    return snapshot_grid(stream_activity(spark, sf_dir), STREAM_CONFIG).frame(spark)


def cohort(name: str):
    def query(spark, sf_dir):
        return stream_profile(spark, sf_dir, replace(STREAM_CONFIG, cohort=name)).select(KEYS)

    return query


def labels(rule: str):
    def query(spark, sf_dir):
        profile = stream_profile(spark, sf_dir, replace(STREAM_CONFIG, churn=rule))
        return columns_like(profile, "future_", "churn")

    return query


def churn_rate_by_snapshot(spark, sf_dir):
    return rounded(folds.base_rates(stream_profile(spark, sf_dir)))


# --- features -----------------------------------------------------------------------------------


def event_features(event: str, cfg: ChurnConfig = STREAM_CONFIG):
    def query(spark, sf_dir):
        profile = stream_profile(spark, sf_dir, cfg, (event,), (event,))
        return rounded(columns_like(profile, f"{event}_", "search_to_"))

    return query


def features_active_days(spark, sf_dir):
    return columns_like(stream_profile(spark, sf_dir, events=ALL_EVENTS), "active_days_")


def features_trend(spark, sf_dir):
    counts = stream_profile(spark, sf_dir, events=ALL_EVENTS)
    return rounded(project(counts, tuple(KEYS), trend_columns(STREAM_CONFIG)))


def features_funnel(spark, sf_dir):
    counts = stream_profile(spark, sf_dir, events=ALL_EVENTS)
    return rounded(project(counts, tuple(KEYS), funnel_columns(STREAM_CONFIG)))


def stream_table(spark, sf_dir) -> FeatureTable:
    return build_feature_table(stream_activity(spark, sf_dir), part_products(spark, sf_dir), STREAM_CONFIG)


def feature_table(spark, sf_dir):
    return rounded(stream_table(spark, sf_dir).frame)


def feature_table_salted(spark, sf_dir):
    """Every join shuffled, and clients with more than a few rows spread over several tasks."""
    activity, cfg = stream_activity(spark, sf_dir), replace(STREAM_CONFIG, broadcast_rows=0)
    bounds = dataset_bounds(activity, hot_rows=70)
    table = build_feature_table(activity, part_products(spark, sf_dir), cfg, bounds=bounds)
    return rounded(table.frame)


def feature_table_stored(spark, sf_dir):
    """Through the five logs and the product table on disk, and the stored feature table."""
    root = stored_logs(spark, sf_dir)
    table = build_feature_table(logs.read_activity(spark, root), logs.read_products(spark, root), STREAM_CONFIG)
    results.write_feature_table(table.frame, f"{root}/features")
    return rounded(results.read_feature_table(spark, f"{root}/features").select(*table.frame.columns))


def snapshot_rewrite(spark, sf_dir):
    """A stored feature table after one snapshot was rewritten in place with a changed column."""
    table = stream_table(spark, sf_dir)
    path = f"{shared_folder(spark)}/ebbline/features-{uuid.uuid4().hex}"
    results.write_feature_table(table.frame, path)
    results.rewrite_snapshots(spark, path, lambda rows: rows.withColumn("active_days_10d", F.col("active_days_10d") + 100), [table.grid.dates[1]])
    return results.read_feature_table(spark, path).select("snapshot_date", "client_id", "active_days_10d", "churn", "split")


def run_metadata(spark, sf_dir):
    record = run_record(spark, stream_table(spark, sf_dir), "events")
    return record.withColumn("window_days", F.concat_ws(",", F.col("window_days").cast("array<string>")))


# --- predictions with the fixed score -----------------------------------------------------------

RECENCY_SCORE = "CAST({e}_recency_days AS DOUBLE) / ({e}_recency_days + {e}_count_10d + 1D)"


def predictions(spark, sf_dir) -> DataFrame:
    profile = stage(stream_profile(spark, sf_dir), "profile")
    scored = profile.selectExpr("*", "churn AS y_true", f"{RECENCY_SCORE.format(e=BUY)} AS y_score")
    return assign_time_splits(scored)


def split_predictions(spark, sf_dir, split: str) -> DataFrame:
    return predictions(spark, sf_dir).filter(F.col("split") == split)


def time_split_sizes(spark, sf_dir):
    sizes = profiling.split_sizes(predictions(spark, sf_dir))
    return sizes


def metrics_overall(spark, sf_dir):
    return rounded(binary_metrics(predictions(spark, sf_dir)))


def metrics_by_snapshot(spark, sf_dir):
    return rounded(binary_metrics(predictions(spark, sf_dir), ["snapshot_date"]))


# Rows per cell that make even small tables use many cells.
SMALL_CELLS = 20


def metrics_in_cells(spark, sf_dir):
    return rounded(Scored(predictions(spark, sf_dir), (), SMALL_CELLS).metrics())


def top_k_big_ids(spark, sf_dir):
    """Client ids near 2^60, which doubles can't tell apart."""
    moved = split_predictions(spark, sf_dir, "test").withColumn("client_id", F.col("client_id") + (1 << 60))
    return rounded(strategy.top_k_strategy(Scored(moved, (), SMALL_CELLS)))


def rank_with_nulls(spark, sf_dir):
    """Ranks by a value that is NULL or NaN in many rows, then by ids near 2^60; per event type."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_type", "event_id + (1L << 60) AS event_id",
        "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN double('NaN') ELSE round(value) END AS value",
    )
    ranked = row_numbers(events, [By("value"), By("event_id", True)], ["event_type"], "place", SMALL_CELLS)
    return ranked.selectExpr("event_type", "event_id - (1L << 60) AS event_id", "place")


def predictions_with_errors(spark, sf_dir):
    return rounded(prediction_frame(predictions(spark, sf_dir)), 12)


def _merged(spark, sf_dir) -> DataFrame:
    """Scored rows with all features of the table."""
    table = _stored_table(spark, sf_dir)
    scored = table.selectExpr(*KEYS, "churn AS y_true", f"{RECENCY_SCORE.format(e=BUY)} AS y_score")
    features = table.select(*KEYS, *feature_names(table, STREAM_CONFIG))
    return stage(errors.with_features(prediction_frame(scored), features), "merged")


def error_profile(spark, sf_dir):
    segmented = errors.value_segments(_merged(spark, sf_dir), f"{BUY}_count_10d")
    return rounded(errors.error_profile(segmented, f"{BUY}_count_10d", "active_days_10d"))


def error_profile_in_cells(spark, sf_dir):
    segmented = errors.value_segments(_merged(spark, sf_dir), f"{BUY}_count_10d", SMALL_CELLS)
    return rounded(errors.error_profile(segmented, f"{BUY}_count_10d", "active_days_10d"))


def error_feature_means(kind: str):
    def query(spark, sf_dir):
        return rounded(errors.error_feature_means(_merged(spark, sf_dir), kind), 6)

    return query


def worst_cases(kind: str):
    def query(spark, sf_dir):
        worst = errors.worst_cases(_merged(spark, sf_dir), kind)
        return rounded(worst.select(*KEYS, "y_true", "y_score", "error_type", f"{BUY}_count_10d"), 12)

    return query


def damaged_predictions(spark, sf_dir):
    """A CSV of predictions with damaged lines: lines that fit, lines that do not, and what the good ones hold."""
    frame = prediction_frame(predictions(spark, sf_dir)).selectExpr("client_id", "snapshot_date", "y_true", "y_score", "y_pred", "error_type")
    path = f"{shared_folder(spark)}/ebbline/damaged-{uuid.uuid4().hex}"
    damaged = F.when(F.col("client_id") % 5 == 0, F.lit("lost")).otherwise(F.col("y_true").cast("string"))
    results.write_csv(frame.withColumn("y_true", damaged), path)
    checked = results.read_csv_checked(spark, path, results.PREDICTION_SCHEMA)
    good = checked.filter(F.col(results.BAD_LINE).isNull()).agg(F.sum("y_true").alias("positives"), F.round(F.sum("y_score"), 6).alias("score_sum"))
    return results.line_counts(checked).crossJoin(good)


def threshold_candidates(spark, sf_dir):
    scored = Scored(split_predictions(spark, sf_dir, "valid"))
    return strategy.threshold_frame(spark, strategy.threshold_candidates(scored)).select("threshold")


def threshold_sweep(spark, sf_dir):
    return rounded(strategy.threshold_sweep(Scored(split_predictions(spark, sf_dir, "valid"))))


def best_threshold(spark, sf_dir):
    sweep = strategy.threshold_sweep(Scored(split_predictions(spark, sf_dir, "valid")))
    return rounded(strategy.best_threshold(sweep))


def _analysis(spark, sf_dir):
    staged = stage(predictions(spark, sf_dir), "scored")
    return run_strategy_analysis(staged.filter("split = 'valid'"), staged.filter("split = 'test'"))


def threshold_summary(spark, sf_dir):
    return rounded(_analysis(spark, sf_dir).threshold_summary)


def top_k_strategy(spark, sf_dir):
    return rounded(strategy.top_k_strategy(Scored(split_predictions(spark, sf_dir, "test"))))


def roi_simulation(preset: str):
    def query(spark, sf_dir):
        return rounded(run_roi_simulation(_analysis(spark, sf_dir), preset)[0], 6)

    return query


def roi_best_strategies(spark, sf_dir):
    return rounded(run_roi_simulation(_analysis(spark, sf_dir), "default")[1], 6)


# --- folds --------------------------------------------------------------------------------------


def _fold_columns(spark, found):
    frame = folds.fold_frame(spark, found)
    return frame.withColumn("train_dates", F.concat_ws(",", F.col("train_dates").cast("array<string>")))


def rolling_folds(spark, sf_dir):
    dates = present_dates(stream_profile(spark, sf_dir).select("snapshot_date"))
    return _fold_columns(spark, folds.rolling_folds(dates))


def _rolling(spark, sf_dir):
    staged = stage(predictions(spark, sf_dir), "scored")
    found = folds.rolling_folds(present_dates(staged))
    members = folds.fold_members(staged.drop("split"), found).withColumn("model", F.lit("fixed_score"))
    measured = binary_metrics(members, ["fold_id", "model", "split"])
    return folds.fold_results(measured, folds.fold_sizes(staged, found))


def rolling_metrics(spark, sf_dir):
    return rounded(_rolling(spark, sf_dir))


def rolling_summary(spark, sf_dir):
    return rounded(folds.backtest_summary(_rolling(spark, sf_dir)))


# --- training rows, models ----------------------------------------------------------------------


def stratified_cap_counts(spark, sf_dir):
    return class_counts(cap_rows(stage(stream_profile(spark, sf_dir), "profile"), CAP))


def stratified_cap_rows(spark, sf_dir):
    return cap_rows(stage(stream_profile(spark, sf_dir), "profile"), CAP).select(*KEYS, "churn")


def _stored_table(spark, sf_dir):
    return stage(stream_table(spark, sf_dir).frame, "features")


def training_class_weights(spark, sf_dir):
    weighted = class_weights(_stored_table(spark, sf_dir).filter("split = 'train'"))
    return weighted.groupBy("churn", F.round("weight", 8).alias("weight")).agg(F.count("*").alias("n_rows"))


def model_inputs(spark, sf_dir):
    """Mean and deviation by which the linear model scales its inputs, per input column."""
    table = _stored_table(spark, sf_dir)
    names = feature_names(table, STREAM_CONFIG)
    scaler = fit(table.filter("split = 'train'"), "logistic_regression", names, effort=FAST).stages[1]
    rows = [(n, float(m), float(d)) for n, m, d in zip(names, scaler.mean.toArray(), scaler.std.toArray())]
    return rounded(spark.createDataFrame(rows, "feature string, mean double, deviation double"), 6)


def model_scored_rows(spark, sf_dir):
    """Rows, positives and probabilities between 0 and 1 per model and split."""
    scored = train_and_evaluate(_stored_table(spark, sf_dir), STREAM_CONFIG, effort=FAST).predictions
    return scored.groupBy("model", "split").agg(
        F.count("*").alias("n_rows"), F.sum("y_true").alias("positives"),
        F.sum(F.col("y_score").between(0, 1).cast("bigint")).alias("n_probabilities"),
    )


def model_comparison(spark, sf_dir):
    return rounded(train_and_evaluate(_stored_table(spark, sf_dir), STREAM_CONFIG, effort=FAST).metrics)


def best_model_refit(spark, sf_dir):
    run = train_and_evaluate(_stored_table(spark, sf_dir), STREAM_CONFIG, effort=FAST)
    return rounded(run.refit_metrics)


def model_feature_importance(spark, sf_dir):
    table = _stored_table(spark, sf_dir)
    names = feature_names(table, STREAM_CONFIG)
    fitted = fit(table.filter("split = 'train'"), "random_forest", names, effort=FAST)
    return feature_importance(spark, fitted, names)


def rolling_backtest_logistic(spark, sf_dir):
    models = ("logistic_regression",)
    return rounded(run_rolling_backtest(_stored_table(spark, sf_dir), STREAM_CONFIG, models, effort=FAST)[0])


def rolling_backtest(spark, sf_dir):
    """All models on all folds, fitted side by side. Sizes and shares of positives are exact; of the metrics only their range is told."""
    measured = run_rolling_backtest(_stored_table(spark, sf_dir), STREAM_CONFIG, effort=FAST)[0]
    return measured.select(
        "fold_id", "model", "split", "train_rows", "valid_rows", "test_rows", F.round("positive_rate", 8).alias("positive_rate"),
        (F.col("auc").between(0, 1) & F.col("pr_auc").between(0, 1)).alias("in_range"),
    )


#: No component of the gradient of the fitted linear model is larger than this.
GRADIENT_BOUND = 1e-5


def logistic_optimality(spark, sf_dir):
    """The linear model at full effort on all training rows: whether its penalised loss, differentiated by the rows, is at its minimum."""
    train = _stored_table(spark, sf_dir).filter("split = 'train'")
    names = feature_names(train, STREAM_CONFIG)
    gradient = logistic_gradient(fit(train, "logistic_regression", names, caps=ALL_ROWS), train, names)
    found = gradient.agg(F.count("*").alias("n_coefficients"), (F.max(F.abs("gradient")) < GRADIENT_BOUND).alias("optimal"))
    return found.crossJoin(train.agg(F.count("*").alias("n_rows"), F.sum("churn").cast("bigint").alias("positives")))


def bootstrap_weights(spark, sf_dir):
    """Rows, draws and summed weights of each class in the bootstraps of a forest of ten."""
    train = _stored_table(spark, sf_dir).filter("split = 'train'")
    counts = bootstrap_class_counts(with_draws(train, 10, STREAM_CONFIG.seed))
    total = F.round(F.col("n_draws") * F.col("class_weight"), 6)
    return counts.select("part", "churn", "n_rows", "n_draws", total.alias("weight_sum"))


#: No leaf of a boosted tree misses the optimum of its penalised loss by more than this.
LEAF_BOUND = 1e-6


def boosted_leaf_values(spark, sf_dir):
    """Per tree of the boosted model: its rows and whether all leaf values are optimal under the penalty."""
    table = _stored_table(spark, sf_dir)
    names = feature_names(table, STREAM_CONFIG)
    train = stage(assembled(table.filter("split = 'train'"), names), "assembled")
    fitted = fit(train, "boosted_subsampled", names, effort=FAST)
    residuals = leaf_residuals(fitted.stages[1:], train, STEP, LEAF_PENALTY)
    return residuals.select("tree", "n_rows", "positives", (F.col("residual") < LEAF_BOUND).alias("optimal"))


# --- comparison and descriptions ----------------------------------------------------------------


DEFINITIONS = [(cohort, STREAM_CONFIG.churn) for cohort in COHORTS]


def definition_rates(spark, sf_dir):
    """Three cohorts by two churn rules from one pass over the events."""
    activity = stream_activity(spark, sf_dir)
    bounds = dataset_bounds(activity)
    profile = snapshot_profile(day_rows(activity), grid_between(bounds, STREAM_CONFIG), STREAM_CONFIG, events=(BUY,), bounds=bounds, every_definition=True)
    return rounded(profile_rates(profile))


def run_comparison(spark, sf_dir):
    """Three stored runs, one per cohort, each with its full feature table and two fixed scores in the place of models."""
    tables = build_feature_tables(stream_activity(spark, sf_dir), part_products(spark, sf_dir), STREAM_CONFIG, DEFINITIONS)
    scored = reduce(DataFrame.unionByName, [
        table.frame.selectExpr(*KEYS, "split", "churn AS y_true", f"{RECENCY_SCORE.format(e=event)} AS y_score", f"'{cohort}' AS prefix", f"'{model}' AS model")
        for (cohort, _), table in tables.items()
        for model, event in (("buy_score", BUY), ("page_score", PAGE))
    ])
    metrics = stage(binary_metrics(scored, ["prefix", "model", "split"]), "metrics")
    root = f"{shared_folder(spark)}/ebbline/runs-{uuid.uuid4().hex}"
    for (cohort, _), table in tables.items():
        own = metrics.filter(F.col("prefix") == cohort)
        best = choose_best_model(own).select("model")
        refit = own.filter("split = 'test'").join(F.broadcast(best), "model", "left_semi").withColumn("split", F.lit("test_refit"))
        write_run(root, cohort, run_record(spark, table, "events"), own.filter("split <> 'train'"), refit)
    return rounded(read_runs(spark, root).compare())


def histogram_of(column: str):
    def query(spark, sf_dir):
        table = stage(stream_profile(spark, sf_dir, events=ALL_EVENTS), "profile")
        return rounded(profiling.histogram(table, column))

    return query


def label_distribution(spark, sf_dir):
    return profiling.label_distribution(stream_profile(spark, sf_dir))


def vector_text_parse(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    text = F.concat(F.lit("["), F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), ", "), F.lit("]"))
    parsed = rows.select("vec_id", parse_vector(text).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return parsed.select(
        "vec_id",
        F.size("v").cast("bigint").alias("n_values"),
        F.round(total, 6).alias("value_sum"),
        F.round(F.array_max("v"), 8).alias("value_max"),
    )


# --- orders as a log of buys --------------------------------------------------------------------


def orders_cohort_sizes(spark, sf_dir):
    return rounded(folds.base_rates(orders_profile(spark, sf_dir)))


def orders_buy_features(spark, sf_dir):
    profile = orders_profile(spark, sf_dir, details=(BUY,))
    return rounded(columns_like(profile, "churn", f"{BUY}_"), 6)


def orders_rolling_folds(spark, sf_dir):
    dates = present_dates(orders_profile(spark, sf_dir).select("snapshot_date"))
    return _fold_columns(spark, folds.rolling_folds(dates))


QUERIES = {
    "binary_metrics_in_cells": metrics_in_cells,
    "top_k_big_ids": top_k_big_ids,
    "rank_with_nulls": rank_with_nulls,
    "error_profile_in_cells": error_profile_in_cells,
    "feature_table_salted": feature_table_salted,
    "feature_table_stored": feature_table_stored,
    "training_class_weights": training_class_weights,
    "model_inputs": model_inputs,
    "model_scored_rows": model_scored_rows,
    "activity_daily_rollup": activity_daily_rollup,
    "client_active_days": client_active_days,
    "clean_page_log": clean_page_log,
    "clean_product_table": clean_product_table,
    "client_sample": client_sample,
    "buyer_event_counts": buyer_event_counts,
    "search_day_conversions": search_day_conversions,
    "event_volume": event_volume,
    "dataset_bounds": time_bounds,
    "snapshot_grid": grid_dates,
    "cohort_historical_buyers": cohort("historical_buyers"),
    "cohort_recently_active": cohort("recently_active_buyers"),
    "cohort_recent_engaged": cohort("recent_engaged_buyers"),
    "labels_no_buy": labels("no_buy_in_label_window"),
    "labels_strict": labels("no_buy_and_low_future_activity"),
    "churn_rate_by_snapshot": churn_rate_by_snapshot,
    "features_product_buy": event_features(BUY),
    "features_add_to_cart": event_features(CART),
    "features_remove_from_cart": event_features(REMOVE),
    "features_page_visit": event_features(PAGE),
    "features_search": event_features(SEARCH),
    "features_search_leak_safe": event_features(SEARCH, replace(STREAM_CONFIG, leak_safe=True)),
    "features_active_days": features_active_days,
    "features_trend": features_trend,
    "features_funnel": features_funnel,
    "feature_table": feature_table,
    "run_metadata": run_metadata,
    "time_split_sizes": time_split_sizes,
    "stratified_cap_counts": stratified_cap_counts,
    "stratified_cap_rows": stratified_cap_rows,
    "binary_metrics": metrics_overall,
    "binary_metrics_by_snapshot": metrics_by_snapshot,
    "prediction_frame": predictions_with_errors,
    "error_profile": error_profile,
    "false_positive_feature_means": error_feature_means("false_positive"),
    "false_negative_feature_means": error_feature_means("false_negative"),
    "worst_false_positives": worst_cases("false_positive"),
    "worst_false_negatives": worst_cases("false_negative"),
    "threshold_candidates": threshold_candidates,
    "threshold_sweep": threshold_sweep,
    "best_threshold": best_threshold,
    "threshold_summary": threshold_summary,
    "top_k_strategy": top_k_strategy,
    "roi_simulation": roi_simulation("default"),
    "roi_simulation_realistic": roi_simulation("realistic_ecommerce"),
    "roi_best_strategies": roi_best_strategies,
    "rolling_folds": rolling_folds,
    "rolling_metrics": rolling_metrics,
    "rolling_summary": rolling_summary,
    "model_comparison": model_comparison,
    "best_model_refit": best_model_refit,
    "feature_importance": model_feature_importance,
    "rolling_backtest_logistic": rolling_backtest_logistic,
    "rolling_backtest": rolling_backtest,
    "logistic_optimality": logistic_optimality,
    "bootstrap_weights": bootstrap_weights,
    "boosted_leaf_values": boosted_leaf_values,
    "run_comparison": run_comparison,
    "definition_rates": definition_rates,
    "event_volume_footers": event_volume_footers,
    "cleaned_logs_by_view": cleaned_logs_by_view,
    "text_times": text_times,
    "snapshot_rewrite": snapshot_rewrite,
    "damaged_predictions": damaged_predictions,
    "active_days_histogram": histogram_of("active_days_10d"),
    "buy_count_histogram": histogram_of(f"{BUY}_count_10d"),
    "label_distribution": label_distribution,
    "vector_text_parse": vector_text_parse,
    "orders_cohort_sizes": orders_cohort_sizes,
    "orders_buy_features": orders_buy_features,
    "orders_rolling_folds": orders_rolling_folds,
}
