"""Stratified cap on training rows: exact class quotas, chosen by a hash of the row keys."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.scalar import uniform_key
from ebbline.operators.ranking import By, row_numbers


def class_counts(table: DataFrame, label: str = "churn") -> DataFrame:
    return table.groupBy(label).agg(F.count("*").alias("n_rows"))


def class_quotas(counts: dict[int, int], cap: int) -> dict[int, int]:
    """Rows to keep per class: its rounded share of ``cap``, at least one and at most all, as far as the shares of the
    classes before it leave room."""
    values, total = sorted(counts), sum(counts.values())
    shares = [min(max(1, round(cap * counts[v] / total)), counts[v]) for v in values]
    rooms = [cap - used for used in accumulate(shares, initial=0)]
    return {v: min(share, room) for v, share, room in zip(values, shares, rooms) if room > 0}


def cap_rows(table: DataFrame, cap: int | None, seed: int = 42, label: str = "churn", bucket_rows: int = 500_000):
    """At most ``cap`` rows with the class mix of ``table``. Places left by rounding go to the next rows in
    hash order, whatever their class.

    Only keys and hash are ranked, to find the last row each class keeps; the wide rows are then filtered
    where they are. Keys are unique.
    """
    if cap is None:
        return table
    counts = {r[label]: r.n_rows for r in class_counts(table, label).collect()}
    if sum(counts.values()) <= cap:
        return table
    quotas = class_quotas(counts, cap)
    spare = cap - sum(quotas.values())  # only rounding leaves places free, so there are fewer than classes
    keyed = table.withColumn("_u", uniform_key(seed, "client_id", "snapshot_date"))
    keys = ["_u", "client_id", "snapshot_date"]
    ranked = row_numbers(keyed.select(label, *keys), [By(k) for k in keys], [label], "_rank", bucket_rows)
    quota = F.create_map(*[F.lit(x) for pair in quotas.items() for x in pair])
    place = F.col("_rank") - F.coalesce(quota[F.col(label)], F.lit(0))
    around = ranked.withColumn("_place", place).filter(F.col("_place").between(0, spare) & (F.col("_rank") > 0))
    rows = around.orderBy(*keys).collect()  # a few per class

    def at_key(row) -> Column:
        return F.struct(*[F.lit(row[k]).cast(keyed.schema[k].dataType).alias(k) for k in keys])

    spot = F.struct(*keys)
    kept = [(F.col(label) == r[label]) & (spot <= at_key(r)) for r in rows if r["_place"] == 0]
    kept += [spot == at_key(r) for r in [r for r in rows if r["_place"] > 0][:spare]]
    return keyed.filter(reduce(Column.__or__, kept)).drop("_u")
