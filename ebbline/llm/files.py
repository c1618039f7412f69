"""Sharded binary files in the shared folder: deterministic ranges, temporary names, manifests.

A task writes under a temporary name that no other attempt uses and renames the complete file to its final name.
The content of a shard depends on the rows only, so a repeated or speculative attempt puts the same bytes in the same
place. The rows that the tasks return form the manifest, which Spark's own writer commits; readers open only what a
committed manifest names, so leftovers of lost executors are never read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbline.session import shared_folder

#: Raw bytes a shard holds, and the number of shards up to which smaller ones are made to keep all cores busy.
SHARD_BYTES = 256 << 20
SMALL_SHARD_BYTES = 1 << 20
SMALL_SHARDS = 192
#: Shards at most: beyond them shards grow with the data, so the driver's share stays bounded.
MAX_SHARDS = 20_000
#: Sampled keys per shard from which the bounds are taken, so about 800,000 at most.
KEYS_PER_SHARD = 40


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/ebbline/{label}-{uuid.uuid4().hex}"


def file_system(uri: str):
    """The Arrow file system of a folder, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Draft:
    """A file under a temporary name until ``publish``."""

    def __init__(self, folder: str, name: str) -> None:
        self.fs, base = file_system(folder)
        self.fs.create_dir(base, recursive=True)
        self.final, self.temporary = f"{base}/{name}", f"{base}/_{name}.{uuid.uuid4().hex}.tmp"
        self.stream = self.fs.open_output_stream(self.temporary)
        self.bytes = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def publish(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, self.final)


def shard_count(total_bytes: int) -> int:
    return min(max(-(-total_bytes // SHARD_BYTES), min(-(-total_bytes // SMALL_SHARD_BYTES), SMALL_SHARDS), 1), MAX_SHARDS)


def sharder(df: DataFrame, key: str, tie: Column, size: Column) -> tuple[int, callable]:
    """Ranges of (``key``, ``tie``) with about equally many rows, the same in every run over the same rows.

    Returns the number of shards and a function from two columns to the shard number. The bounds come from keys whose
    hash is divisible by a number chosen from the row count: KEYS_PER_SHARD keys a shard reach the driver. Nulls sort first.
    """
    low = -(1 << 63)
    keys = df.select(F.coalesce(F.col(key), F.lit(low)).alias("k"), tie.cast("long").alias("t"), size.alias("s"))
    rows, total = keys.agg(F.count(F.lit(1)), F.sum(F.col("s").cast("long"))).first()
    shards = shard_count(total or 0)
    every = max(1, rows // (shards * KEYS_PER_SHARD))
    sample = keys.where(F.pmod(F.xxhash64("k", "t"), F.lit(every)) == 0).select("k", "t").distinct()
    found = sorted(tuple(r) for r in sample.collect()) if shards > 1 else []
    bounds = sorted({found[len(found) * i // shards] for i in range(1, shards)}) if found else []
    firsts = np.array([b[0] for b in bounds], np.int64)
    seconds = np.array([b[1] for b in bounds], np.int64)

    @F.pandas_udf("int")
    def place(k: pd.Series, t: pd.Series) -> pd.Series:
        a, b = k.to_numpy(np.int64), t.to_numpy(np.int64)
        at, until = np.searchsorted(firsts, a, "left"), np.searchsorted(firsts, a, "right")
        for i in np.flatnonzero(at != until):  # rows whose key is itself a bound
            at[i] += np.searchsorted(seconds[at[i] : until[i]], b[i], "right")
        return pd.Series(at.astype(np.int32))

    return shards, lambda k, t: place(F.coalesce(k, F.lit(low)), t.cast("long"))
