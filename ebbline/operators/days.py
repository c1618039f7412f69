"""Activity at day grain.

Snapshots are midnights and windows whole days, so ``ts >= s - k days`` is ``day >= s - k`` and
every feature can be computed from day rows with a weight ``n``. ``day_rows`` gives one row per event
without a shuffle; ``daily_rollup`` gives the same schema pre-aggregated, worth writing
once when several definitions or windows are computed from one log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.scalar import word_count

DAY_KEYS = ("client_id", "event", "day", "sku", "url")
DAY_SUMS = ("n", "n_text", "text_chars", "text_words")


def day_rows(activity: DataFrame) -> DataFrame:
    """``client_id, event, day, sku, url`` plus weight and text sums; rows without a time are useless here."""
    query = F.col("query")
    return activity.filter(F.col("ts").isNotNull()).select(
        "client_id",
        "event",
        F.to_date("ts").alias("day"),
        "sku",
        "url",
        F.lit(1).cast("bigint").alias("n"),
        query.isNotNull().cast("bigint").alias("n_text"),
        F.length(query).cast("bigint").alias("text_chars"),
        word_count(query).cast("bigint").alias("text_words"),
    )


def daily_rollup(activity: DataFrame) -> DataFrame:
    """Day rows summed per client, event, day and item. The item in the key spreads hot clients."""
    return day_rows(activity).groupBy(*DAY_KEYS).agg(*[F.sum(c).alias(c) for c in DAY_SUMS])


def client_days(days: DataFrame) -> DataFrame:
    """Distinct active days per client over all logs."""
    return days.select("client_id", "day").distinct()
