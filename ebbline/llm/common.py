"""Helpers shared by the operators: reading tables and Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Entries a worker remembers between batches. A memory bound only: a forgotten entry is computed again.
CACHE_ENTRIES = 400_000
#: Bytes of text whose words are held as Python objects at a time.
SLICE_BYTES = 3 << 20
#: Bytes of an Arrow batch inside ``small_batches``. By default Spark sends 10,000 rows at a time, 30 MB of common texts, and both the
#: executor and its workers keep from the system what a batch once took.
BATCH_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column as UTF-8 bytes, a null as empty bytes."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str = "_text", most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text (SLICE_BYTES by default), a longer text alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(sizes) // (most or SLICE_BYTES)
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is computed meanwhile goes to Python in Arrow batches of about BATCH_BYTES; a size that the session already has stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    ours = spark.conf.get(name, None) is None
    if ours:
        spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        if ours:
            spark.conf.unset(name)


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str, most: int | None = None) -> DataFrame:
    """Apply ``make`` to Arrow batches with a column ``_text``, cut into ``slices``; it returns the columns of the rows it makes."""

    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=most):
                columns = make(part)
                yield pa.record_batch([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def quoted(df: DataFrame) -> list[str]:
    """The columns of ``df`` as select reads them, whatever signs are in their names."""
    return ["`{}`".format(c.replace("`", "``")) for c in df.columns]


def without_rows(df: DataFrame, marked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` whose id and text hash are not those of a row of ``marked`` (doc_id, text_hash)."""
    d, t = unused(df, "_d", "_t")
    marked = marked.select(F.col("doc_id").alias(d), F.col("text_hash").alias(t)).distinct()
    return df.join(marked, F.col(id_col).cast("long").eqNullSafe(F.col(d)) & F.xxhash64(F.col(text_col).cast("string")).eqNullSafe(F.col(t)), "left_anti")


def bounded(cache: dict | set, entries: int = CACHE_ENTRIES) -> None:
    """Empty a cache that has outgrown its bound."""
    if len(cache) > entries:
        cache.clear()
