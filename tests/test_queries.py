"""Registered queries against their SQL, and the driver contract. All of them with EBBLINE_ALL=1."""

import os

import pytest

import __spark_entry__ as contract
from ebbline.oracle import ORACLES
from compare import oracle_connection, oracle_rows, schema_differences, spark_rows

QUICK = (
    "activity_daily_rollup",
    "search_day_conversions",
    "cohort_historical_buyers",
    "cohort_recently_active",
    "labels_strict",
    "feature_table",
    "features_search_leak_safe",
    "stratified_cap_rows",
    "binary_metrics_by_snapshot",
    "error_profile",
    "top_k_strategy",
    "rolling_metrics",
    "buy_count_histogram",
    "orders_buy_features",
    "rank_with_nulls",
    "binary_metrics_in_cells",
    "top_k_big_ids",
    "feature_table_salted",
    "feature_table_stored",
    "model_inputs",
    "roi_best_strategies",
    "false_positive_feature_means",
    "definition_rates",
    "bootstrap_weights",
    "boosted_leaf_values",
    "run_comparison",
)
NAMES = sorted(ORACLES) if os.environ.get("EBBLINE_ALL") else QUICK


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, oracle, name):
    df = contract.queries()[name](spark, sf_dir)
    sql = contract.oracle_sql()[name]
    assert not schema_differences(df, oracle, sql)
    assert spark_rows(df) == oracle_rows(oracle, sql)


def test_entry(spark):
    rows = contract.entry(spark).orderBy("snapshot_date").collect()
    assert [(r.cohort_size, r.churned) for r in rows] == [(15, 4), (15, 5), (12, 2), (12, 2), (13, 3), (14, 7)]


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
