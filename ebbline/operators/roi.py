"""Expected return of targeting strategies under economic scenarios."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.scalar import ratio_or_null


@dataclass(frozen=True)
class Scenario:
    name: str
    contact_cost: float
    incentive_cost: float
    gross_profit: float
    uplift: float


# Scenario presets.
PRESETS = {
    "default": (
        Scenario("conservative", 0.5, 12.0, 120.0, 0.03),
        Scenario("base", 0.5, 15.0, 180.0, 0.05),
        Scenario("aggressive", 0.5, 18.0, 240.0, 0.08),
    ),
    "realistic_ecommerce": (
        Scenario("realistic_tight", 0.6, 20.0, 55.0, 0.01),
        Scenario("realistic_base", 0.6, 22.0, 80.0, 0.02),
        Scenario("realistic_strong", 0.6, 28.0, 120.0, 0.03),
    ),
}


def scenarios_of(preset: str) -> tuple[Scenario, ...]:
    if preset not in PRESETS:
        raise ValueError(f"unknown scenario preset: {preset}")
    return PRESETS[preset]


def _scenario_struct(s: Scenario) -> Column:
    return F.struct(
        F.lit(s.name).alias("scenario"),
        F.lit(s.contact_cost).alias("contact_cost_per_user"),
        F.lit(s.incentive_cost).alias("incentive_cost_per_saved_user"),
        F.lit(s.gross_profit).alias("gross_profit_per_saved_user"),
        F.lit(s.uplift).alias("uplift_on_true_churners"),
    )


def top_k_as_strategy(top_k: DataFrame) -> DataFrame:
    label = F.format_string("top_%dpct", F.bround(F.col("top_k_pct") * 100).cast("int"))
    return top_k.select(
        F.lit("top_k").alias("strategy_kind"),
        label.alias("strategy_label"),
        F.col("top_k_pct").alias("strategy_value"),
        "targeted_users",
        "churn_precision",
    )


def thresholds_as_strategy(summary: DataFrame) -> DataFrame:
    renamed = summary.withColumnRenamed("precision", "churn_precision")
    return renamed.select(
        F.lit("threshold").alias("strategy_kind"),
        F.format_string("threshold_%.2f", "threshold").alias("strategy_label"),
        F.col("threshold").alias("strategy_value"),
        "targeted_users",
        "churn_precision",
    )


def expected_roi(strategies: DataFrame, scenarios: Sequence[Scenario]) -> DataFrame:
    """One row per strategy and scenario; a return without cost is undefined (NULL)."""
    scenario = F.explode(F.array(*[_scenario_struct(s) for s in scenarios])).alias("s")
    users = F.col("targeted_users").cast("double")
    saved, contact, incentive = (F.col(f"expected_{n}") for n in ("saved_users", "contact_cost", "incentive_cost"))
    margin = F.col("gross_profit_per_saved_user") - F.col("incentive_cost_per_saved_user")
    total, net = F.col("expected_total_cost"), F.col("expected_net_profit")
    return (
        strategies.select("*", scenario)
        .select(*strategies.columns, "s.*")
        .withColumn("expected_true_churners", users * F.col("churn_precision"))
        .withColumn("expected_saved_users", F.col("expected_true_churners") * F.col("uplift_on_true_churners"))
        .withColumn("expected_contact_cost", users * F.col("contact_cost_per_user"))
        .withColumn("expected_incentive_cost", saved * F.col("incentive_cost_per_saved_user"))
        .withColumn("expected_total_cost", contact + incentive)
        .withColumn("expected_gross_profit", saved * F.col("gross_profit_per_saved_user"))
        .withColumn("expected_net_profit", F.col("expected_gross_profit") - total)
        .withColumn("expected_roi", F.when(total > 0, ratio_or_null(net, total)))
        .withColumn("break_even_saved_users", contact / F.greatest(margin, F.lit(1e-9)))
    )


def best_strategies(roi: DataFrame, keep: int = 3) -> DataFrame:
    """The most profitable strategies of each scenario."""
    order = Window.partitionBy("scenario").orderBy(
        F.col("expected_net_profit").desc(), F.col("expected_roi").desc(), "strategy_kind", "strategy_label"
    )
    return roi.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= keep).drop("_place")


def roi_simulation(top_k: DataFrame, thresholds: DataFrame, preset: str = "default") -> DataFrame:
    strategies = top_k_as_strategy(top_k).unionByName(thresholds_as_strategy(thresholds))
    return expected_roi(strategies, scenarios_of(preset))
