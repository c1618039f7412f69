"""Running totals and ranks over a total order, without sorting everything in one task.

A plain window without ``partitionBy`` moves all rows to a single task. Here rows are dealt into cells
by ranges of the whole order, stored, sorted cell by cell, and start from the totals of the cells before theirs. The
ranges compare the columns in their own types, NULL and NaN included, and cover all order columns, so
neither ties nor large ids gather in one cell or change places. Every size takes the same path.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.session import stage

MIN_CELLS = 4
# Rows of a cell by default. A cell is a partition, so ``bucket_rows`` below this asks for at most FINE_CELLS cells; tables
# that need more get cells of CELL_ROWS rows.
CELL_ROWS = 500_000
FINE_CELLS = 200


@dataclass(frozen=True)
class By:
    """One order column. NULL comes first in ascending and last in descending order."""

    name: str
    descending: bool = False

    @property
    def sort(self) -> Column:
        return F.col(self.name).desc() if self.descending else F.col(self.name).asc()


def cell_count(n_rows: int, bucket_rows: int) -> int:
    """Cells for ``n_rows`` rows: tasks and offsets stay few, however small the wished cells are."""
    cells = -(-n_rows // bucket_rows)
    if cells > FINE_CELLS:
        cells = max(FINE_CELLS, -(-n_rows // max(bucket_rows, CELL_ROWS)))
    return max(MIN_CELLS, cells)


def in_cells(df: DataFrame, order: Sequence[By], group: Sequence[str], bucket_rows: int) -> DataFrame:
    """Stored rows with ``_cell``, the number of a range of (group, order) with about ``bucket_rows`` rows, or more if these
    would be too many cells. Which range a row falls in may differ between runs; totals do not."""
    cells = cell_count(df.count(), bucket_rows)
    ranged = df.repartitionByRange(cells, *[F.col(g).asc() for g in group], *[by.sort for by in order])
    return stage(ranged.withColumn("_cell", F.spark_partition_id()), "cells")


def running_totals(
    df: DataFrame,
    measures: dict[str, str],
    order: Sequence[By],
    group: Sequence[str] = (),
    bucket_rows: int = CELL_ROWS,
) -> DataFrame:
    """Add ``sum(measure)`` from the first row of the group up to each row in the given total order.

    ``measures`` maps output names to SQL expressions; ``{"rank": "1"}`` is a row number. ``df`` is read up to
    three times and stored once, so pass a cheap projection. ``order`` must be total within a group.
    """
    exprs = {name: F.expr(sql) for name, sql in measures.items()}
    placed = in_cells(df, order, group, bucket_rows)
    per_cell = placed.groupBy(*group, "_cell").agg(*[F.sum(expr).alias(f"_t_{name}") for name, expr in exprs.items()])
    # As many rows as cells, and one more per group.
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_cell.select(
        *[F.col(c).alias(f"_k_{c}") for c in (*group, "_cell")],
        *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_o_{name}") for name in exprs],
    )
    inside = Window.partitionBy(*group, "_cell").orderBy(*[by.sort for by in order])
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    totals = {name: F.sum(expr).over(inside) + F.col(f"_o_{name}") for name, expr in exprs.items()}
    same = reduce(Column.__and__, [placed[c].eqNullSafe(offsets[f"_k_{c}"]) for c in (*group, "_cell")])
    return placed.join(offsets, same).withColumns(totals).select(*df.columns, *exprs)


def row_numbers(
    df: DataFrame, order: Sequence[By], group: Sequence[str] = (), name: str = "rank", bucket_rows: int = CELL_ROWS
) -> DataFrame:
    return running_totals(df, {name: "1L"}, order, group, bucket_rows)
