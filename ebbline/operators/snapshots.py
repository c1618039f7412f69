"""Dataset bounds, the snapshot grid, fan-out of day rows to snapshots, and time splits."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.config import BUY, ChurnConfig
from ebbline.operators.joins import HOT_ROWS, HotKeys, fits_broadcast, hot_keys, join_key_table

DAY = dt.timedelta(days=1)


def ever_buyers(activity: DataFrame) -> DataFrame:
    return activity.filter(F.col("event") == BUY).select("client_id").distinct()


def buyer_activity(activity: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """Events of clients that ever bought."""
    buyers = ever_buyers(activity)
    small = fits_broadcast(buyers, cfg.broadcast_rows)
    hot = None if small else hot_keys(activity, "client_id", least_parts=cfg.join_salts)
    return join_key_table(activity, buyers, "client_id", "left_semi", broadcast=small, hot=hot)


@dataclass(frozen=True)
class Bounds:
    """Time span of the buyers' events, number of buyers, the clients known to hold very many rows, and the rows of all clients."""

    min_ts: dt.datetime | None
    max_ts: dt.datetime | None
    n_buyers: int
    hot: HotKeys | None = None
    n_rows: int | None = None

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.min_ts, self.max_ts)], "min_ts timestamp_ntz, max_ts timestamp_ntz")


def _buyer_bounds(activity: DataFrame, rows: str, hot: HotKeys | None, n_rows: int) -> Bounds:
    """Bounds over the events of buyers that match ``rows``. One aggregate per client takes the place of a
    join with the buyers, and partial aggregation absorbs hot clients."""
    per_client = (
        activity.filter(f"event = '{BUY}' OR {rows}")
        .groupBy("client_id")
        .agg(
            F.expr(f"min(CASE WHEN {rows} THEN ts END) AS low"),
            F.expr(f"max(CASE WHEN {rows} THEN ts END) AS high"),
            F.expr(f"max(event = '{BUY}') AS bought"),
        )
    )
    row = per_client.filter("bought").agg(F.min("low"), F.max("high"), F.count("*")).first()
    return Bounds(*row, hot, n_rows)


def dataset_bounds(activity: DataFrame, hot_rows: int = HOT_ROWS) -> Bounds:
    """First and last event time over all logs, buyers only, and the heavy clients.

    The first and last day of the whole data almost always hold an event of some buyer, so only
    these days (and the small buy log) are grouped by client; if they do not, all events are.
    """
    whole = activity.agg(F.min("ts").alias("low"), F.max("ts").alias("high"), F.count("*").alias("n")).first()
    hot = hot_keys(activity, "client_id", whole.n, hot_rows)
    if whole.low is None:
        return Bounds(None, None, 0)
    head_end, tail_start = whole.low.date() + DAY, whole.high.date()
    in_head, in_tail = f"ts < TIMESTAMP_NTZ '{head_end}'", f"ts >= TIMESTAMP_NTZ '{tail_start}'"
    found = _buyer_bounds(activity, f"({in_head} OR {in_tail})", hot, whole.n)
    if found.min_ts is not None and found.min_ts.date() < head_end and found.max_ts.date() >= tail_start:
        return found
    return _buyer_bounds(activity, "true", hot, whole.n)


def rollup_bounds(rollup: DataFrame, hot_rows: int = HOT_ROWS) -> Bounds:
    """Bounds by whole days from a stored daily rollup; the grid asks for no more."""
    return dataset_bounds(rollup.withColumn("ts", F.col("day").cast("timestamp_ntz")), hot_rows)


@dataclass(frozen=True)
class SnapshotGrid:
    """Regular midnights ``first + k * step``, ``k < count``."""

    first: dt.date
    step: int
    count: int

    @property
    def dates(self) -> list[dt.date]:
        return [self.first + k * self.step * DAY for k in range(self.count)]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The grid as a table."""
        start, stop = F.lit(self.dates[0]), F.lit(self.dates[-1])
        step = F.make_dt_interval(F.lit(self.step)).cast("interval day")
        return spark.range(1).select(F.explode(F.sequence(start, stop, step)).alias("snapshot_date"))


def grid_between(bounds: Bounds, cfg: ChurnConfig) -> SnapshotGrid:
    """Snapshots with a full observation window before and a full label window after them."""
    if bounds.min_ts is None or bounds.max_ts is None:
        raise ValueError("no dated events of buyers: cannot place snapshots")
    first = bounds.min_ts.date() + cfg.observation_days * DAY
    last = bounds.max_ts.date() - cfg.label_days * DAY
    if first >= last:
        raise ValueError("history too short for one observation and one label window")
    count = (last - first).days // cfg.snapshot_step_days + 1
    if cfg.max_snapshots is not None and count > cfg.max_snapshots:
        first += (count - cfg.max_snapshots) * cfg.snapshot_step_days * DAY
        count = cfg.max_snapshots
    if count < 3:
        raise ValueError("train, valid and test need at least three snapshots")
    return SnapshotGrid(first, cfg.snapshot_step_days, count)


def snapshot_grid(activity: DataFrame, cfg: ChurnConfig) -> SnapshotGrid:
    return grid_between(dataset_bounds(activity), cfg)


def fan_out(
    rows: DataFrame, grid: SnapshotGrid, back: int | None, ahead: int, after: str | None = None, until: str | None = None
) -> DataFrame:
    """Repeat each row for every snapshot ``s`` with ``s - back <= day < s + ahead``; ``back`` may be open.

    The covering snapshots are an index range of the grid, so no join and no test of every
    snapshot is needed. ``after`` / ``until`` name optional date columns:
    ``after < s`` and ``s <= until + back``. ``lead`` is ``s - day`` in days: 1..back before the
    snapshot, 0 and below in the days after it.
    """
    origin = f"DATE '{grid.first}'"

    def steps(day: str, shift: int) -> str:
        return f"floor((datediff({day}, {origin}) + {shift}) / {grid.step}D)"

    low = ["0L", f"{steps('day', -ahead)} + 1"]
    high = [f"{grid.count - 1}L"]
    if back is not None:
        high.append(steps("day", back))
    if after is not None:
        low.append(f"{steps(after, 0)} + 1")
    if until is not None:
        high.append(steps(until, back))
    first = f"greatest({', '.join(low)})"
    last = f"least({', '.join(high)})" if len(high) > 1 else high[0]
    return (
        rows.selectExpr("*", f"{first} AS _low", f"{last} AS _high")
        .filter("_low <= _high")
        .selectExpr("*", "explode(sequence(_low, _high)) AS _k")
        .selectExpr("*", f"date_add({origin}, CAST(_k * {grid.step} AS INT)) AS snapshot_date")
        .selectExpr("* EXCEPT (_low, _high, _k)", "datediff(snapshot_date, day) AS lead")
    )


def split_names(count: int) -> list[str]:
    """Split of each of ``count`` dates in time order: about 60 / 20 / 20 percent, never random."""
    train = max(1, 3 * count // 5)
    test = min(max(train + 1, 4 * count // 5), count - 1)
    return [("train", "valid", "test")[(i >= train) + (i >= test)] for i in range(count)]


def present_dates(table: DataFrame) -> list[dt.date]:
    """Snapshots that occur in the table, in order (at most the size of the grid)."""
    return sorted(r.snapshot_date for r in table.select("snapshot_date").distinct().collect())


def split_column(dates: list[dt.date]) -> Column:
    """Split by position among the dates present; snapshots without any row do not count."""
    names = F.create_map(*[F.lit(x) for pair in zip(dates, split_names(len(dates))) for x in pair])
    return names[F.col("snapshot_date")]
