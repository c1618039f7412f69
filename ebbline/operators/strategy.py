"""Who to target: threshold sweep and top-K tables, and the threshold chosen on validation data."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.scalar import is_close, ratio_or_null, safe_divide
from ebbline.operators.metrics import Scored, threshold_columns

# Shares of the top-K table and quantiles that join the regular thresholds.
TOP_SHARES = (0.01, 0.02, 0.05, 0.10, 0.20)
THRESHOLD_QUANTILES = (0.50, 0.60, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95, 0.975, 0.99)
REGULAR_THRESHOLDS = tuple(i / 20 for i in range(1, 20))


def score_quantiles(scored: Scored, probs: Sequence[float]) -> list[float]:
    """Exact quantiles with linear interpolation.

    The order statistics around each position are looked up in the cumulative histogram, so at most two
    rows per quantile reach the driver and no task holds all scores."""
    total = scored.numbers.total
    if not total:
        return []
    positions = [(total - 1) * p for p in probs]
    wanted = sorted({int(i) for x in positions for i in (np.floor(x), np.ceil(x))})
    ranges = scored.cumulative.selectExpr("y_score", f"{total}L - cum_n AS first", "n")  # rows with a smaller score
    rows = ranges.filter(f"exists(array({', '.join(f'{i}L' for i in wanted)}), i -> i >= first AND i < first + n)").collect()

    def statistic(i: int) -> float:
        return next(r.y_score for r in rows if r["first"] <= i < r["first"] + r.n)

    out = []
    for x in positions:
        low, high = statistic(int(np.floor(x))), statistic(int(np.ceil(x)))
        out.append(low + (high - low) * (x - np.floor(x)))
    return out


def threshold_candidates(scored: Scored) -> list[float]:
    """Regular steps of 0.05 and score quantiles, rounded to 4 digits, distinct, inside (0, 1)."""
    values = [*REGULAR_THRESHOLDS, *score_quantiles(scored, THRESHOLD_QUANTILES)]
    return [float(t) for t in np.unique(np.round(values, 4)) if 0 < t < 1]


def threshold_frame(spark: SparkSession, thresholds: Sequence[float]) -> DataFrame:
    """``position`` 1.. and ``threshold`` in ascending order."""
    values = ", ".join(f"{float(t)!r}D" for t in sorted(thresholds))
    exploded = spark.range(1).selectExpr(f"posexplode(array({values})) AS (p, threshold)")
    return exploded.selectExpr("p + 1 AS position", "threshold")


def threshold_sweep(scored: Scored, thresholds: Sequence[float] | None = None) -> DataFrame:
    """Targeted rows and metrics per threshold.

    Every score is placed between two thresholds once; a threshold then owns all places at or above its own. One
    pass over the histogram, whatever the number of thresholds."""
    thresholds = sorted(threshold_candidates(scored) if thresholds is None else thresholds)
    spark = scored.rows.sparkSession
    reached = F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: t <= F.col("y_score"))
    places = (
        scored.cumulative.withColumn("place", F.size(reached))
        .groupBy("place")
        .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
        .filter("place > 0")
        .selectExpr("explode(sequence(1, place)) AS position", "n", "pos")
        .groupBy("position")
        .agg(F.sum("n").alias("targeted_users"), F.sum("pos").alias("hits"))
    )
    totals = scored.numbers
    fixed = scored.metrics().select("auc", "pr_auc", "top_10pct_churn_recall", "positive_rate").first()
    targeted, hits = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("targeted_users", "hits"))
    at_threshold = threshold_columns(targeted, hits, F.lit(totals.positives))
    return (
        threshold_frame(spark, thresholds)
        .join(places, "position", "left")
        .select(
            "threshold",
            targeted.alias("targeted_users"),
            safe_divide(targeted, F.lit(max(totals.total, 1))).alias("targeted_share"),
            F.lit(fixed.auc).cast("double").alias("auc"),
            F.lit(fixed.pr_auc).cast("double").alias("pr_auc"),
            *[c.alias(name) for name, c in at_threshold.items()],
            F.lit(fixed.top_10pct_churn_recall).alias("top_10pct_churn_recall"),
            F.lit(fixed.positive_rate).cast("double").alias("positive_rate"),
        )
        .orderBy("threshold")
    )


def best_threshold(sweep: DataFrame, by: str = "f1") -> DataFrame:
    """The sweep row with the highest ``by``, then recall, precision and threshold."""
    return sweep.orderBy(*[F.col(c).desc() for c in (by, "recall", "precision", "threshold")]).limit(1)


def threshold_summary(test_sweep: DataFrame, chosen: float, baseline: float = 0.5) -> DataFrame:
    """Test rows at the baseline and at the threshold chosen on validation data."""

    def tagged(value: float, tag: str) -> DataFrame:
        return test_sweep.filter(is_close(F.col("threshold"), F.lit(value))).withColumn("strategy", F.lit(tag))

    return tagged(baseline, "threshold_0.50").unionByName(tagged(chosen, "threshold_f1_opt"))


def top_k_strategy(scored: Scored, shares: Sequence[float] = TOP_SHARES) -> DataFrame:
    """Size, captured positives, precision, recall and lift of the best-scored share of rows."""
    numbers = scored.numbers
    base = ratio_or_null(F.lit(numbers.positives), F.lit(numbers.total))
    precision = ratio_or_null(F.col("captured"), F.col("size"))
    return (
        scored.top(shares)
        .select(
            F.col("share").alias("top_k_pct"),
            F.col("size").alias("targeted_users"),
            F.col("captured").alias("captured_churn_users"),
            precision.alias("churn_precision"),
            safe_divide(F.col("captured"), F.lit(max(numbers.positives, 1))).alias("churn_recall"),
            ratio_or_null(precision, base).alias("lift_vs_base"),
            (F.col("score_sum") / F.col("size")).alias("avg_score"),
            base.alias("baseline_churn_rate"),
        )
        .orderBy("top_k_pct")
    )
