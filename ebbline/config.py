"""Run parameters and the fixed vocabulary of events and definitions."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

# Event names of the five logs.
BUY = "product_buy"
CART = "add_to_cart"
REMOVE = "remove_from_cart"
PAGE = "page_visit"
SEARCH = "search_query"

PRODUCT_EVENTS = (BUY, CART, REMOVE)
ENGAGEMENT_EVENTS = (PAGE, CART, BUY)
ALL_EVENTS = (PAGE, CART, REMOVE, BUY, SEARCH)

# Cohort and churn definitions with the text stored in run metadata.
COHORTS = {
    "historical_buyers": "user had at least one product_buy before the snapshot",
    "recently_active_buyers": (
        "user had at least one product_buy before the snapshot and at least one "
        "page_visit/add_to_cart/product_buy in the observation window"
    ),
    "recent_engaged_buyers": (
        "user had at least one product_buy in the observation window and at least one "
        "page_visit/add_to_cart/product_buy in the last {recent_days} days before the snapshot"
    ),
}
CHURN_RULES = {
    "no_buy_in_label_window": "user is churned if there is no product_buy in the next label window",
    "no_buy_and_low_future_activity": (
        "user is churned if there is no product_buy in the next label window and future activity "
        "spans at most {low_activity_days} active day"
    ),
}


@dataclass(frozen=True)
class ChurnConfig:
    """Windows are whole days; snapshots are midnights, so day arithmetic is exact."""

    observation_days: int = 30
    label_days: int = 14
    snapshot_step_days: int = 14
    max_snapshots: int | None = None
    count_windows: tuple[int, ...] = (1, 3, 7, 14)
    trend_pairs: tuple[tuple[int, int], ...] = ((7, 30), (3, 14))
    recent_days: int = 7
    low_activity_days: int = 1
    cohort: str = "recent_engaged_buyers"
    churn: str = "no_buy_and_low_future_activity"
    leak_safe: bool = False
    sample_frac: float | None = None
    seed: int = 42
    # Largest build side that is broadcast; beyond it joins are salted and shuffled.
    broadcast_rows: int = 1_000_000
    join_salts: int = 32

    def __post_init__(self) -> None:
        if self.cohort not in COHORTS:
            raise ValueError(f"unknown cohort definition: {self.cohort}")
        if self.churn not in CHURN_RULES:
            raise ValueError(f"unknown churn definition: {self.churn}")
        for name in ("observation_days", "label_days", "snapshot_step_days", "recent_days"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if max(self.windows) > self.observation_days:
            raise ValueError("count windows must fit inside the observation window")
        known = set(self.windows)
        for short, long in self.trend_pairs:
            if not (short < long and {short, long} <= known):
                raise ValueError(f"trend pair ({short}, {long}) must be two known count windows, short first")
        if self.recent_days > self.observation_days:
            raise ValueError("recent_days must fit inside the observation window")
        if self.snapshot_step_days < self.label_days:
            warnings.warn("label windows of neighbouring snapshots overlap", stacklevel=2)

    @property
    def windows(self) -> tuple[int, ...]:
        """Count windows in ascending order; the observation window is always the last."""
        return tuple(sorted({*self.count_windows, self.observation_days}))

    @property
    def cohort_text(self) -> str:
        return COHORTS[self.cohort].format(recent_days=self.recent_days)

    @property
    def churn_text(self) -> str:
        return CHURN_RULES[self.churn].format(low_activity_days=self.low_activity_days)
