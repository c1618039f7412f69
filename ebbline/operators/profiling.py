"""Simple descriptions of a feature table: histograms and label counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(table: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the extremes of a whole-number column; the last bin is closed, and
    empty bins are listed. A constant column lies in the middle of a unit range around it."""
    bounds = table.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    spark = table.sparkSession
    low, high = bounds.low, bounds.high
    if low is None:
        return spark.range(0).selectExpr("CAST(id AS INT) AS bin", "0D AS bin_start", "0D AS bin_end", "0L AS n_rows")
    if low == high:
        bin_of, start, width = F.lit(bins // 2), low - 0.5, 1.0 / bins
    else:
        bin_of = F.least(F.lit(bins - 1), F.expr(f"CAST(({column} - {low}) * {bins} DIV {high - low} AS INT)"))
        start, width = float(low), (high - low) / bins
    counts = table.filter(F.col(column).isNotNull()).groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n_rows"))
    return (
        spark.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(start) + F.col("bin") * F.lit(width)).alias("bin_start"),
            (F.lit(start) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
            F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
        )
    )


def label_distribution(table: DataFrame) -> DataFrame:
    return table.groupBy("churn").agg(F.count("*").alias("n_rows"))


def split_sizes(table: DataFrame) -> DataFrame:
    return table.groupBy("split").agg(
        F.count_distinct("snapshot_date").alias("n_snapshots"),
        F.min("snapshot_date").alias("first_snapshot"),
        F.max("snapshot_date").alias("last_snapshot"),
        F.count("*").alias("n_rows"),
        F.sum("churn").alias("n_churned"),
    )
