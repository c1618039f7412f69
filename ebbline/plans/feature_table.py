"""The complete feature table: 100 columns with the default configuration, and its run record."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.config import ALL_EVENTS, ChurnConfig
from ebbline.operators.days import daily_rollup
from ebbline.operators.derived import funnel_columns, trend_columns
from ebbline.operators.profile import of_definition, project, snapshot_profile
from ebbline.operators.snapshots import (
    Bounds,
    SnapshotGrid,
    grid_between,
    present_dates,
    rollup_bounds,
    split_column,
)
from ebbline.session import stage
from ebbline.sources.logs import sample_clients
from ebbline.sources.results import RUN_RECORD_SCHEMA


@dataclass(frozen=True)
class FeatureTable:
    frame: DataFrame
    grid: SnapshotGrid
    config: ChurnConfig


def add_derived(profile: DataFrame, cfg: ChurnConfig) -> DataFrame:
    return project(profile, ("*",), trend_columns(cfg) | funnel_columns(cfg))


def assign_time_splits(table: DataFrame) -> DataFrame:
    return table.withColumn("split", split_column(present_dates(table)))


def build_feature_table(
    activity: DataFrame,
    products: DataFrame,
    cfg: ChurnConfig,
    bounds: Bounds | None = None,
    rollup: DataFrame | None = None,
) -> FeatureTable:
    """``bounds`` skips the passes that find them; ``rollup`` reuses a stored daily rollup.

    The logs are read once, for the daily rollup; bounds, buyers, heavy clients and all branches read that. The aggregate is staged once, because the split depends on the dates present in it; the derived columns are
    a narrow projection of the staged rows.
    """
    if rollup is None:
        rollup = stage(daily_rollup(sample_clients(activity, cfg.sample_frac, cfg.seed)), "rollup")
    days = sample_clients(rollup, cfg.sample_frac, cfg.seed)
    bounds = bounds or rollup_bounds(days)
    grid = grid_between(bounds, cfg)
    profile = snapshot_profile(days, grid, cfg, products, ALL_EVENTS, ALL_EVENTS, bounds, rolled=True)
    staged = stage(profile, "profile")
    return FeatureTable(add_derived(assign_time_splits(staged), cfg), grid, cfg)


def build_feature_tables(
    activity: DataFrame, products: DataFrame, cfg: ChurnConfig, definitions: list[tuple[str, str]], rollup: DataFrame | None = None
) -> dict[tuple[str, str], FeatureTable]:
    """The feature table of every (cohort, churn rule), all from one profile that is computed and stored once."""
    if rollup is None:
        rollup = stage(daily_rollup(sample_clients(activity, cfg.sample_frac, cfg.seed)), "rollup")
    days = sample_clients(rollup, cfg.sample_frac, cfg.seed)
    bounds = rollup_bounds(days)
    grid = grid_between(bounds, cfg)
    profile = snapshot_profile(days, grid, cfg, products, ALL_EVENTS, ALL_EVENTS, bounds, rolled=True, every_definition=True)
    staged = stage(profile, "definitions")
    out = {}
    for cohort, churn in definitions:
        own = replace(cfg, cohort=cohort, churn=churn)
        out[cohort, churn] = FeatureTable(add_derived(assign_time_splits(of_definition(staged, cohort, churn)), own), grid, own)
    return out


def run_record(spark: SparkSession, table: FeatureTable, dataset_root: str) -> DataFrame:
    """One row that describes the run. ``feature_count`` counts all columns, keys and label included."""
    cfg = table.config
    values = {
        "dataset_root": dataset_root,
        "observation_days": cfg.observation_days,
        "label_days": cfg.label_days,
        "window_days": list(cfg.windows),
        "snapshot_step_days": cfg.snapshot_step_days,
        "max_snapshots": cfg.max_snapshots,
        "sample_frac": cfg.sample_frac,
        "snapshot_count": table.grid.count,
        "feature_count": len(table.frame.columns),
        "active_user_definition": cfg.cohort,
        "active_user_definition_detail": cfg.cohort_text,
        "churn_definition": cfg.churn,
        "churn_definition_detail": cfg.churn_text,
    }
    types = {f.name: f.dataType for f in RUN_RECORD_SCHEMA}

    def literal(name: str):
        value = values[name]
        column = F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)
        return column.cast(types[name]).alias(name)

    counted = table.frame.agg(F.count("*").alias("row_count"))
    return counted.select(
        [F.col("row_count") if f.name == "row_count" else literal(f.name) for f in RUN_RECORD_SCHEMA]
    )
