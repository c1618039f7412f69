"""Exact ranking metrics for binary predictions, for any number of groups in one job.

Predictions need ``client_id, snapshot_date, y_true, y_score`` plus the group columns. ROC-AUC and
average precision only depend on how many rows and positives share a score, so they are computed
on that histogram. Undefined values are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ebbline.functions.scalar import ratio_or_null, safe_divide
from ebbline.operators.ranking import By, row_numbers, running_totals
from ebbline.session import stage

SCORE_COLUMNS = ("client_id", "snapshot_date", "y_true", "y_score")


def score_histogram(predictions: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Rows and positives per distinct score, staged because several passes follow."""
    counts = predictions.groupBy(*group, "y_score").agg(
        F.count("*").alias("n"), F.sum(F.col("y_true").cast("bigint")).alias("pos")
    )
    return stage(counts, "scores")


def cumulative_histogram(histogram: DataFrame, group: Sequence[str] = (), bucket_rows: int = 500_000) -> DataFrame:
    """Adds ``cum_n`` and ``cum_pos``: rows and positives at or above each score."""
    return running_totals(histogram, {"cum_n": "n", "cum_pos": "pos"}, [By("y_score", True)], group, bucket_rows)


def curve_columns() -> dict[str, Column]:
    """Aggregates over a cumulative histogram."""
    n, pos, cum_n, cum_pos = (F.col(c).cast("double") for c in ("n", "pos", "cum_n", "cum_pos"))
    neg = n - pos
    negatives_above = (cum_n - n) - (cum_pos - pos)
    positives, negatives = F.sum(pos), F.sum(neg)
    return {
        # share of (positive, negative) pairs with the positive on top; ties count half
        "auc": 1 - ratio_or_null(F.sum(pos * (negatives_above + neg / 2)), positives * negatives),
        # steps in recall times the precision at the step; not the trapezoid
        "pr_auc": safe_divide(F.sum(pos * cum_pos / cum_n), positives),
    }


def threshold_columns(targeted: Column, hits: Column, positives: Column) -> dict[str, Column]:
    precision, recall = safe_divide(hits, targeted), safe_divide(hits, positives)
    return {"precision": precision, "recall": recall, "f1": safe_divide(2 * hits, targeted + positives)}


def totals_of(cumulative: DataFrame, group: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """Everything a metric needs from the histogram, one row per group."""
    targeted = F.col("y_score") >= threshold
    return cumulative.groupBy(*group).agg(
        F.sum("n").alias("total"),
        F.sum("pos").alias("positives"),
        F.coalesce(F.sum(F.when(targeted, F.col("n"))), F.lit(0)).alias("targeted"),
        F.coalesce(F.sum(F.when(targeted, F.col("pos"))), F.lit(0)).alias("hits"),
        *[c.alias(name) for name, c in curve_columns().items()],
    )


TOTALS = ("total", "positives", "targeted", "hits", "auc", "pr_auc")


class Scored:
    """Predictions with their score histogram, shared by metrics, sweeps and top-K tables.

    ``predictions`` are read several times: pass stored rows or a cheap projection of them. The histogram
    is staged.
    """

    def __init__(self, predictions: DataFrame, group: Sequence[str] = (), bucket_rows: int = 500_000):
        self.group, self.bucket_rows = list(group), bucket_rows
        self._totals: dict[float, DataFrame] = {}
        self.rows = predictions.select(*dict.fromkeys([*self.group, *SCORE_COLUMNS]))
        self.cumulative = cumulative_histogram(score_histogram(self.rows, self.group), self.group, bucket_rows)

    @cached_property
    def numbers(self) -> Row:
        """Totals without groups, at threshold 0.5."""
        return totals_of(self.cumulative).first()

    def _with_totals(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """Group totals on every row; without groups they are one row of numbers and become literals.

        The staged totals have a known size, so a handful of groups is broadcast: a shuffle by
        group would send everything to a handful of tasks."""
        if self.group:
            if threshold not in self._totals:
                self._totals[threshold] = stage(totals_of(self.cumulative, self.group, threshold), "totals")
            return df.join(self._totals[threshold], self.group)
        row = self.numbers if threshold == 0.5 else totals_of(self.cumulative, (), threshold).first()
        return df.withColumns({c: F.lit(row[c]).cast("double" if c in ("auc", "pr_auc") else "bigint") for c in TOTALS})

    def top(self, shares: Sequence[float]) -> DataFrame:
        """Per group and share: size of the top (``max(1, floor(total * share))``), positives and score sum in it.

        Scores entirely inside the top come from the histogram. Only rows of the one score that straddles the
        cut are ranked, by client and snapshot; the other predictions are never sorted.
        """
        group, above = self.group, F.col("cum_n") - F.col("n")
        reached = (
            self._with_totals(self.cumulative)
            .withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
            .withColumn("size", F.expr("greatest(1L, floor(total * share))"))
            .filter(above < F.col("size"))
            .withColumn("need", F.when(F.col("cum_n") > F.col("size"), F.col("size") - above))
        )
        inside = reached.groupBy(*group, "share").agg(
            F.max("size").alias("size"),
            F.expr("coalesce(sum(CASE WHEN need IS NULL THEN pos END), 0L) AS captured"),
            F.expr("sum(coalesce(need, n) * y_score) AS score_sum"),
        )
        # At most one row per group and share; staging it gives the planner its true size.
        cut = stage(reached.filter("need IS NOT NULL").select(*group, "share", "y_score", "need"), "cut")
        if cut.isEmpty():
            return inside
        tie = [*group, "y_score"]
        tied = self.rows.join(cut.select(*tie).distinct(), tie, "left_semi")
        tied = tied.withColumn("_day", F.unix_date("snapshot_date"))
        ranked = row_numbers(tied, [By("client_id"), By("_day")], tie, "rank", self.bucket_rows)
        from_ties = (
            ranked.join(cut, tie)
            .filter("rank <= need")
            .groupBy(*group, "share")
            .agg(F.expr("sum(CAST(y_true AS BIGINT)) AS from_ties"))
        )
        captured = F.col("captured") + F.coalesce("from_ties", F.lit(0))
        return inside.join(from_ties, [*group, "share"], "left").withColumn("captured", captured).drop("from_ties")

    def metrics(self, threshold: float = 0.5, top_share: float = 0.1) -> DataFrame:
        """One row per group: ROC-AUC, average precision, precision / recall / F1 at the threshold, share of
        the positives found in the top rows, positive rate."""
        at_threshold = threshold_columns(F.col("targeted"), F.col("hits"), F.col("positives"))
        recall_name = f"top_{round(top_share * 100)}pct_churn_recall"
        return self._with_totals(self.top([top_share]), threshold).select(
            *self.group,
            "auc",
            "pr_auc",
            *[c.alias(name) for name, c in at_threshold.items()],
            safe_divide(F.col("captured"), F.greatest(F.col("positives"), F.lit(1))).alias(recall_name),
            ratio_or_null(F.col("positives"), F.col("total")).alias("positive_rate"),
        )


def binary_metrics(
    predictions: DataFrame, group: Sequence[str] = (), threshold: float = 0.5, top_share: float = 0.1
) -> DataFrame:
    return Scored(predictions, group).metrics(threshold, top_share)


def prediction_frame(scores: DataFrame) -> DataFrame:
    """Adds the decision at 0.5 and the kind of error."""
    predicted = (F.col("y_score") >= 0.5).cast("int")
    kind = (
        F.when((F.col("y_true") == 1) & (F.col("y_pred") == 0), "false_negative")
        .when((F.col("y_true") == 0) & (F.col("y_pred") == 1), "false_positive")
        .otherwise("correct")
    )
    return scores.select(*SCORE_COLUMNS).withColumn("y_pred", predicted).withColumn("error_type", kind)
