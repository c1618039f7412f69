"""Bindings of general tables (an event stream; orders) to the activity contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.config import BUY, CART, PAGE, PRODUCT_EVENTS, REMOVE, SEARCH, ChurnConfig
from ebbline.sources.logs import ACTIVITY_SCHEMA

# Which event_type plays the part of which log.
EVENT_TYPE_TO_LOG = {"purchase": BUY, "click": CART, "error": REMOVE, "view": PAGE, "signup": SEARCH}

# The event stream spans 30 days, the orders seven years; windows are scaled to that.
STREAM_CONFIG = ChurnConfig(
    observation_days=10,
    label_days=3,
    snapshot_step_days=3,
    count_windows=(1, 3, 7),
    trend_pairs=((3, 10), (1, 7)),
    recent_days=2,
    churn="no_buy_in_label_window",
)
ORDERS_CONFIG = ChurnConfig(
    observation_days=365,
    label_days=180,
    snapshot_step_days=180,
    count_windows=(30, 90, 180),
    trend_pairs=((90, 365), (30, 180)),
    recent_days=365,
    cohort="historical_buyers",
    churn="no_buy_in_label_window",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as activity; one scan serves all five logs."""
    names = " ".join(f"WHEN '{kind}' THEN '{log}'" for kind, log in EVENT_TYPE_TO_LOG.items())
    key = F.regexp_extract("props", r'"k": *([0-9]+)', 1).try_cast("bigint")
    event = F.col("event")
    return (
        _table(spark, sf_dir, "events")
        .filter(F.col("user_id").isNotNull() & F.col("event_type").isin(*EVENT_TYPE_TO_LOG))
        .withColumn("event", F.expr(f"CASE event_type {names} END"))
        .select(
            F.col("user_id").alias("client_id"),
            "ts",
            event,
            F.when(event.isin(*PRODUCT_EVENTS), key).alias("sku"),
            F.when(event == PAGE, key).alias("url"),
            F.when(event == SEARCH, F.col("props")).alias("query"),
        )
        .filter(~event.isin(*PRODUCT_EVENTS) | F.col("sku").isNotNull())
        .to(ACTIVITY_SCHEMA)
    )


def part_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as product table; ``p_partkey`` is its primary key, so no de-duplication is needed."""
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku"),
        F.col("p_size").cast("bigint").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with their lines as a log of buys."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .filter(F.col("o_custkey").isNotNull() & F.col("l_partkey").isNotNull())
        .select(
            F.col("o_custkey").alias("client_id"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
            F.lit(BUY).alias("event"),
            F.col("l_partkey").alias("sku"),
            F.lit(None).cast("bigint").alias("url"),
            F.lit(None).cast("string").alias("query"),
        )
    )
