"""Document fingerprints by a quartile bucket digest.

Every window of WINDOW bytes of the UTF-8 text gives the triplets of its newest byte with two of the others. A triplet is hashed
by tables of fixed random numbers, one for each distance from the newest byte, to one of BUCKETS counters. The digest
holds for every bucket the quartile of the counts that its own count lies in (2 bits), the length on a logarithmic scale, and
the first two quartiles as parts of the third. It does not grow with the text, and a small edit moves few buckets.

The difference of two digests sums a weight per bucket (0, 1, 2 or 6 for 0 to 3 quartiles apart), LENGTH_WEIGHT per step of length
and RATIO_WEIGHT per step of the ratios; it is cut at LIMIT, which is what unrelated texts reach. The likeness is 1 - difference / LIMIT.

A null text counts as empty; texts under WINDOW bytes have empty counters, so they differ by their lengths only. Equal texts have
equal digests. Rows are ordered by id, nulls first, equal ids by a hash of the text; equal rows follow one another.
The next text of the last row is that of the first, so a table of one row follows itself; an empty table gives an empty one. Columns
other than the two named ones are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbline.llm import files
from ebbline.llm.common import slices

BUCKETS, WINDOW = 128, 5
#: Distances of the two other bytes of a triplet from the newest one.
PAIRS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
LENGTH_STEPS = 8
WEIGHTS = np.array([0, 1, 2, 6], np.int64)
LENGTH_WEIGHT, RATIO_WEIGHT, LIMIT = 2, 2, 240
#: Bytes that are hashed at a time.
BLOCK = 1 << 18
_TABLES = np.random.default_rng(12_2024).integers(0, BUCKETS, (WINDOW, 256), dtype=np.uint8)


def bucket_counts(data: bytes) -> np.ndarray:
    """How many triplets of ``data`` fall in each bucket; texts of any length take BLOCK bytes at a time."""
    total = np.zeros(BUCKETS, np.int64)
    values = np.frombuffer(data, np.uint8)
    for start in range(0, len(values) - WINDOW + 1, BLOCK):
        part = values[start : start + BLOCK + WINDOW - 1]
        n = len(part) - WINDOW + 1
        # the byte at distance d from the newest one of every window
        at = [table.take(part[WINDOW - 1 - d : WINDOW - 1 - d + n]) for d, table in enumerate(_TABLES)]
        for i, j in PAIRS:
            total += np.bincount(at[0] ^ at[i] ^ at[j], minlength=BUCKETS)
    return total


def digest(data: bytes) -> np.ndarray:
    """Length step, two ratios and the quartile of every bucket."""
    counts = bucket_counts(data)
    quarter = BUCKETS // 4
    q1, q2, q3 = (int(x) for x in np.sort(counts)[[quarter - 1, 2 * quarter - 1, 3 * quarter - 1]])
    out = np.empty(3 + BUCKETS, np.uint8)
    out[0] = min(255, round(LENGTH_STEPS * math.log2(len(data) + 1)))
    out[1], out[2] = (15 * q1 // q3, 15 * q2 // q3) if q3 else (0, 0)
    out[3:] = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    return out


def to_text(parts: np.ndarray) -> str:
    """The digest as hex: two digits of length, one for each ratio, then four buckets to a byte."""
    body = parts[3:].reshape(-1, 4) << np.array([6, 4, 2, 0], np.uint8)
    return f"{parts[0]:02x}{parts[1]:x}{parts[2]:x}{body.sum(axis=1, dtype=np.uint8).tobytes().hex()}"


def from_text(text: str) -> np.ndarray:
    body = np.frombuffer(bytes.fromhex(text[4:]), np.uint8)
    head = [int(text[:2], 16), int(text[2], 16), int(text[3], 16)]
    return np.concatenate([np.array(head, np.uint8), ((body[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).ravel()])


def difference(a: np.ndarray, b: np.ndarray) -> int:
    """0 (alike) to LIMIT."""
    apart = np.abs(a.astype(np.int16) - b)
    return int(min(LIMIT, LENGTH_WEIGHT * int(apart[0]) + RATIO_WEIGHT * int(apart[1] + apart[2]) + int(WEIGHTS[apart[3:]].sum())))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1.0 - difference(a, b) / LIMIT


def edited(text: str, after: str) -> str:
    """``text`` with its second half replaced by as many characters of the beginning of ``after``, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row, without any shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            marks = [to_text(digest((t or "").encode())) for t in batch.column("_text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_shard, _ahead, _id, _text in shards of ascending ids, every shard sorted and followed by the row (_ahead) that comes after it.

    Texts are shuffled once. The first row of a shard also goes to the shard before it, that of the first shard to the last; which rows these
    are is found from ids and hashes. One row a shard reaches the driver, at most files.MAX_SHARDS.
    """
    low = F.lit(-(1 << 63))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    shards, place = files.sharder(rows, "_id", F.col("_tie"), F.octet_length("_text"))
    placed = rows.withColumn("_shard", place(F.col("_id"), F.col("_tie")))
    firsts = placed.groupBy("_shard").agg(F.min(F.struct(F.coalesce("_id", low).alias("k"), F.col("_tie").alias("t"))).alias("f")).orderBy("_shard").collect()
    spark = df.sparkSession
    heads = [(r.f.k, r.f.t, firsts[i - 1]["_shard"]) for i, r in enumerate(firsts)]
    head = F.broadcast(spark.createDataFrame(heads, "k long, t long, before int"))
    marked = placed.join(head, (F.coalesce("_id", low) == F.col("k")) & (F.col("_tie") == F.col("t")), "left")
    goes = lambda shard, ahead: F.struct(shard.alias("_shard"), F.lit(ahead).alias("_ahead"))
    own = F.array(goes(F.col("_shard"), False))
    both = F.array(goes(F.col("_shard"), False), goes(F.col("before"), True))
    dealt = marked.select("_id", "_text", "_tie", F.explode(F.when(F.col("before").isNull(), own).otherwise(both)).alias("to"))
    dealt = dealt.select("to._shard", "to._ahead", "_id", "_tie", "_text").repartition(shards, "_shard")
    return dealt.sortWithinPartitions("_shard", "_ahead", F.col("_id").asc_nulls_first(), "_tie").select("_shard", "_ahead", "_id", "_text")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's digest, that of its text edited with the next row's, and the likeness to either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that waits for the next one: shard, id, text, digest
        for batch in (part for whole in batches for part in slices(whole)):
            out = []
            for shard, ahead, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("_shard", "_ahead", "_id", "_text"))):
                if ahead and (held is None or held[0] != shard):
                    continue  # the rows behind a shard may hold equal ones
                own = digest(text.encode())
                if held is not None:
                    _, last_id, last_text, last = held
                    data = edited(last_text, text).encode()
                    other = digest(data)
                    out.append((last_id, len(last_text), hashlib.sha256(data).hexdigest(), to_text(last), to_text(other), likeness(last, other), likeness(last, own)))
                held = None if ahead else (shard, doc_id, text, own)
            columns = list(zip(*out)) or [()] * 7
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), *(pa.string(),) * 3, pa.float64(), pa.float64()))], names=[f.split()[0] for f in SCHEMA.split(", ")])
        if held is not None:
            raise ValueError("a shard ends without the row that follows it")

    return with_next(df, id_col, text_col).mapInArrow(run, SCHEMA)
