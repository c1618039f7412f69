"""Where predictions go wrong: profile by value segment, worst cases, mean features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.operators.ranking import By, row_numbers

KEYS = ("client_id", "snapshot_date")
# Segment names from the lowest to the highest quarter.
SEGMENTS = ("low", "mid_low", "mid_high", "high")
NOT_FEATURES = ("client_id", "y_true", "y_pred")


def with_features(predictions: DataFrame, features: DataFrame) -> DataFrame:
    return predictions.join(features, list(KEYS), "left")


def value_segments(merged: DataFrame, column: str, bucket_rows: int = 500_000) -> DataFrame:
    """Adds ``value_segment``: equal quarters of the rows ranked by ``column``, ties by client and snapshot.

    With fewer than four distinct values there are as many segments as values; a single value gives
    ``unknown``."""
    stats = merged.agg(F.count(column).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).first()
    if stats.n == 0 or stats.low == stats.high:
        return merged.withColumn("value_segment", F.lit("unknown"))
    keys = [column, *KEYS]
    narrow = merged.select(*keys).filter(F.col(column).isNotNull())
    segments = narrow.select(column).distinct().limit(len(SEGMENTS)).count()
    ranked = row_numbers(narrow, [By(k) for k in keys], (), "_rank", bucket_rows)
    # Cut points lie at (n - 1) * i / q counted from rank 1; a rank on a cut belongs to the lower segment. Segment i ends
    # with the last rank at or below its cut: these few rows are all that the wide rows are compared with.
    last = {(stats.n - 1) * i // segments + 1: i for i in range(1, segments)}
    ends = ranked.filter(F.col("_rank").isin(list(last))).orderBy("_rank").collect()
    spot = F.struct(*keys)
    ends = [F.struct(*[F.lit(r[k]).cast(merged.schema[k].dataType).alias(k) for k in keys]) for r in ends]
    passed = sum(((spot > end).cast("int") for end in ends), F.lit(0))
    names = F.array(*[F.lit(s) for s in SEGMENTS])
    segment = F.when(F.col(column).isNull(), "unknown").otherwise(F.get(names, passed))
    return merged.withColumn("value_segment", segment)


def error_profile(segmented: DataFrame, buy_count: str, active_days: str) -> DataFrame:
    return segmented.groupBy("error_type", "value_segment").agg(
        F.count("*").alias("users"),
        F.avg("y_score").alias("avg_score"),
        F.avg(buy_count).alias(f"avg_{buy_count.removeprefix('product_')}"),
        F.avg(active_days).alias(f"avg_{active_days}"),
    )


def worst_cases(merged: DataFrame, error_type: str, keep: int = 200) -> DataFrame:
    """Rows of one error type with the highest scores (a report, so the limit is the feature)."""
    return merged.filter(F.col("error_type") == error_type).orderBy(F.desc("y_score"), *KEYS).limit(keep)


def error_feature_means(merged: DataFrame, error_type: str) -> DataFrame:
    """Mean of every numeric column over the rows of one error type, one row per column."""
    numeric = [
        f.name for f in merged.schema if isinstance(f.dataType, T.NumericType) and f.name not in NOT_FEATURES
    ]
    subset = merged.filter(F.col("error_type") == error_type)
    means = subset.agg(F.count("*").alias("_n"), *[F.avg(c).cast("double").alias(c) for c in numeric])
    pairs = ", ".join(f"'{c}', `{c}`" for c in numeric)
    return (
        means.filter("_n > 0")
        .selectExpr(f"stack({len(numeric)}, {pairs}) AS (feature, mean_value)")
        .orderBy(F.desc("mean_value"), "feature")
    )
