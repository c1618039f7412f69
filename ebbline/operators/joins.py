"""Join of a large table with a key table, safe when one key holds much of the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.session import stage

# Rows of one key that a task can take; keys with more are spread over several tasks.
HOT_ROWS = 2_000_000
# Rows from which heavy keys are estimated. A key missed or added costs speed, never rows.
HOT_SAMPLE = 20_000_000
# Largest table of heavy keys that is broadcast; beyond it they are joined by a shuffle.
HOT_BROADCAST = 2_000_000


def fits_broadcast(small: DataFrame, max_rows: int) -> bool:
    """True if ``small`` has at most ``max_rows`` rows. A count moves only partial sums."""
    return small.count() <= max_rows


@dataclass(frozen=True)
class HotKeys:
    """Heavy keys as a stored table ``key, parts``: the rows of ``key`` are dealt to ``parts`` parts. No key reaches the driver."""

    table: DataFrame
    count: int

    def mark(self, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` with ``_parts``, which is NULL for the keys that are not heavy."""
        table = self.table.select(F.col("key").alias(key), F.col("parts").alias("_parts"))
        return rows.join(F.broadcast(table) if self.count <= HOT_BROADCAST else table, key, "left")


def hot_keys(rows: DataFrame, key: str, total: int | None = None, hot_rows: int = HOT_ROWS, least_parts: int = 2) -> HotKeys | None:
    """Keys with more than about ``hot_rows`` rows, in one part per ``hot_rows``, ``least_parts`` at least; None without any. Rows are sampled
    and counted per key with partial sums on the map side, so no task gathers more than its share of the keys."""
    total = rows.count() if total is None else total
    if total <= hot_rows:
        return None
    share = min(1.0, HOT_SAMPLE / total)
    keys = rows.select(F.col(key).alias("key")).filter("key IS NOT NULL")
    counts = (keys if share == 1.0 else keys.sample(share, seed=7)).groupBy("key").agg(F.count("*").alias("n"))
    parts = F.greatest(F.ceil(F.col("n") / (share * hot_rows)).cast("int"), F.lit(least_parts))
    table = stage(counts.filter(F.col("n") > hot_rows * share).select("key", parts.alias("parts")), "hot-keys")
    count = table.count()
    return HotKeys(table, count) if count else None


def part_of(*columns: str) -> Column:
    """The part of a marked row by a hash of ``columns``, which a retried task reproduces; 0 for keys that are not heavy."""
    return F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*columns), F.col("_parts"))).otherwise(0).cast("int")


def join_key_table(big: DataFrame, small: DataFrame, key: str, how: str, *, broadcast: bool, hot: HotKeys | None = None) -> DataFrame:
    """``big`` joined to ``small`` (unique on ``key``).

    A checked small side is broadcast. Otherwise only the rows of ``hot`` keys are spread, by a hash of the
    row, and only these keys of ``small`` are repeated. Rolled-up rows differ from
    each other, so their hashes spread. Keys not known to be hot are left to adaptive skew splitting.
    """
    if broadcast:
        return big.join(F.broadcast(small), key, how)
    if hot is None:
        return big.join(small, key, how)
    salted = hot.mark(big, key).withColumn("_salt", part_of(*big.columns)).drop("_parts")
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = hot.mark(small, key).withColumn("_salt", F.explode(parts)).drop("_parts")
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
