"""Passages that repeat across documents, by sparse suffix arrays.

Words: A-Z lower-cased, then maximal runs without ASCII white space. A passage is a run of at least MIN_WORDS words of a document that
another document holds as well. Only the suffixes at minimiser positions are retained: in every window of SPARSE successive positions the
leftmost one with the least hash of GRAM words. As MIN_WORDS = SPARSE + PREFIX - 1, every passage holds a retained position whose PREFIX
following words lie inside it, and equal passages retain the same positions.

1. Retained suffixes whose PREFIX words stand in one document only are dropped; only a hash and a position per suffix are
   shuffled for that.
2. The others get a code of four bytes for each of the SPARSE - 1 words after the prefix and before the position, and are
   sorted by prefix, following words and preceding words. The sort deals a passage that very many documents share to as many tasks as it takes.
3. Every suffix is compared with the nearest ones of other documents before and after it: the match is extended to the right and to the
   left. Matches of at least MIN_WORDS are merged per document.
   The first and last suffixes of each sorted range meet their neighbours of the next range in a second, small comparison.
4. Where a prefix stands at two places only, that comparison is complete. Where it stands at more, the partner need not be the
   neighbour: other documents that share the words after the prefix, but not those before it, can sort in between. There every window of MIN_WORDS
   words is found by the hash of the whole window, at the retained position that its own minimiser is; a window that another
   document holds is a match.

Null, empty and short texts have no passage. Equal rows (id and text) are one document. Null ids are kept, and are told apart by
their texts. Other columns are not read. Positions are word numbers, the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from ebbline.llm.common import texts_of
from ebbline.session import stage

MIN_WORDS = 50
GRAM, PREFIX = 8, 21
SPARSE = MIN_WORDS - PREFIX + 1
AROUND = SPARSE - 1
#: Suffixes emitted at a time.
ROWS = 20_000

_random = np.random.default_rng(20240301)
_PLACES = _random.integers(0, 1 << 63, MIN_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def word_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, at: np.ndarray | slice, length: int) -> np.ndarray:
    """Hashes of the runs of ``length`` words that begin at ``at``."""
    total = np.uint64(0)
    for i in range(length):
        total = total + words[i : len(words) - length + 1 + i][at] * _PLACES[i]
    return _mix(total)


def anchors(words: np.ndarray) -> np.ndarray:
    """The retained position of every window of MIN_WORDS words."""
    if len(words) < MIN_WORDS:
        return np.zeros(0, np.int64)
    grams = run_hashes(words, slice(None), GRAM)[: len(words) - PREFIX + 1]
    windows = np.lib.stride_tricks.sliding_window_view(grams, SPARSE)
    parts = [windows[i : i + 65536].argmin(axis=1) + np.arange(i, min(i + 65536, len(windows))) for i in range(0, len(windows), 65536)]
    return np.concatenate(parts)


def retained(words: np.ndarray) -> np.ndarray:
    """The minimiser positions whose prefix fits the text."""
    return np.unique(anchors(words))


DOC = ("doc_id", "text_hash")


def suffixes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, pos, prefix (hash of the PREFIX words) of every retained suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places, prefixes = [], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for text in texts_of(batch, "_text"):
                words = word_hashes(text)
                at = retained(words)
                counts.append(len(at))
                if len(at):
                    places.append(at)
                    prefixes.append(run_hashes(words, at, PREFIX))
            rows = np.repeat(np.arange(batch.num_rows), counts)
            yield pa.record_batch(
                [batch.column("doc_id").take(pa.array(rows)), batch.column("text_hash").take(pa.array(rows)), pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(prefixes).view(np.int64))],
                names=["doc_id", "text_hash", "pos", "prefix"],
            )

    return _documents(df, id_col, text_col).mapInArrow(run, "doc_id long, text_hash long, pos int, prefix long")


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("_text"))


def shared(found: DataFrame) -> DataFrame:
    """The suffixes whose prefix stands in two documents at least, as one row per document with its ``spots``; ``many``: at
    more than two places."""
    doc = F.xxhash64(*DOC)
    prefixes = found.groupBy("prefix").agg(F.min(doc).alias("a"), F.max(doc).alias("b"), F.count(F.lit(1)).alias("n"))
    prefixes = stage(prefixes.where("a <> b").selectExpr("prefix", "n > 2 AS many"), "shared-prefixes")
    kept = found.join(prefixes, "prefix")
    return kept.groupBy(*DOC).agg(F.collect_set(F.struct("pos", "prefix", "many")).alias("spots"))


SUFFIX = "prefix long, after binary, before binary, doc_id long, text_hash long, pos int"
NAMES = ("prefix", "after", "before", "doc_id", "text_hash", "pos")


def _with_spots(df: DataFrame, spots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = _documents(df, id_col, text_col)
    spots = spots.withColumnsRenamed({"doc_id": "_d", "text_hash": "_t"})
    return docs.join(spots, docs["doc_id"].eqNullSafe(spots["_d"]) & docs["text_hash"].eqNullSafe(spots["_t"])).select(*DOC, "_text", "spots")


def with_surroundings(df: DataFrame, spots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The shared suffixes with the codes of the words after the prefix, and before the position in reverse."""
    rows = _with_spots(df, spots, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text_hash, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), texts_of(batch, "_text"), batch.column("spots").to_pylist()):
                codes = (word_hashes(text) >> np.uint64(32)).astype(">u4")
                ahead, back = codes.tobytes(), codes[::-1].tobytes()
                for spot in places:
                    pos = spot["pos"]
                    end, left = pos + PREFIX, len(codes) - pos
                    out.append((spot["prefix"], ahead[4 * end : 4 * (end + AROUND)], back[4 * left : 4 * (left + AROUND)], doc_id, text_hash, pos))
                    if len(out) >= ROWS:
                        yield _suffix_batch(out)
                        out = []
            yield _suffix_batch(out)

    return rows.mapInArrow(run, SUFFIX)


_TYPES = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32())


def _suffix_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], names=list(NAMES))


def common_words(a: bytes, b: bytes) -> int:
    """The number of leading codes that are equal."""
    if a == b:
        return len(a) // 4
    least = min(len(a), len(b)) // 4
    x, y = np.frombuffer(a, np.uint32, least), np.frombuffer(b, np.uint32, least)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else least


MATCH = "doc_id long, text_hash long, start int, end int, other_doc_id long, other_start int, edge boolean, prefix long, after binary, before binary, pos int"


def _neighbours(sorted_rows: DataFrame, edges: bool) -> DataFrame:
    """Matches of neighbours in every sorted partition. ``edges``: return the outermost suffixes as well."""
    names = MATCH.split(", ")
    schema = pa.schema([(n.split()[0], {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}[n.split()[1]]) for n in names])

    def match(x: tuple, y: tuple) -> Iterator[tuple]:
        right, left = common_words(x[1], y[1]), common_words(x[2], y[2])
        if left + PREFIX + right >= MIN_WORDS:
            for one, other in ((x, y), (y, x)):
                yield (one[3], one[4], one[5] - left, one[5] + PREFIX + right, other[3], other[5] - left, False, None, None, None, None)

    def edge(x: tuple) -> tuple:
        return (x[3], x[4], None, None, None, None, True, x[0], x[1], x[2], x[5])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: list[tuple] = []  # the first suffixes up to the first one of another document or prefix
        streak: list[tuple] = []  # the last suffixes of one document and prefix
        other: tuple | None = None  # the nearest suffix before the streak, of its prefix
        in_head = True
        for batch in batches:
            out: list[tuple] = []
            for x in zip(*(batch.column(n).to_pylist() for n in NAMES)):
                if streak and streak[-1][0] != x[0]:
                    streak, other, in_head = [], None, False
                if streak and streak[-1][3:5] != x[3:5]:
                    for one in streak:
                        out += match(one, x)
                    streak, other = [x], streak[-1]
                    if in_head:
                        head.append(x)
                        in_head = False
                else:
                    if other is not None:
                        out += match(other, x)
                    streak.append(x)
                    if in_head:
                        head.append(x)
                if len(out) >= ROWS:
                    yield batch_of(out)
                    out = []
            yield batch_of(out)
        if edges:
            yield batch_of([edge(x) for x in (*head, other, *streak) if x is not None])

    return sorted_rows.mapInArrow(run, MATCH)


def matches(rows: DataFrame, partitions: int) -> DataFrame:
    """doc_id, text_hash, start, end, other_doc_id, other_start of neighbouring suffixes that match far enough."""
    order = ["prefix", "after", "before", *DOC, "pos"]
    ranged = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    found = stage(_neighbours(ranged, True), "passage-matches")
    # A few suffixes per range: those of one document and prefix at either end, and one more.
    rims = found.where("edge").select(*NAMES).distinct().coalesce(1).sortWithinPartitions(*order)
    columns = (*DOC, "start", "end", "other_doc_id", "other_start")
    return found.where("NOT edge").select(*columns).union(_neighbours(rims, False).select(*columns))


WINDOW = "prefix long, window long, doc_id long, text_hash long, start int"


def windows(df: DataFrame, spots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """prefix and window (hashes), doc_id, text_hash, start of the windows whose retained position has a prefix at many places."""
    rows = _with_spots(df, spots.withColumn("spots", F.filter("spots", lambda s: s["many"])).where("size(spots) > 0"), id_col, text_col)
    names, types = [c.split()[0] for c in WINDOW.split(", ")], (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text_hash, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), texts_of(batch, "_text"), batch.column("spots").to_pylist()):
                words = word_hashes(text)
                at = anchors(words)
                places = sorted((s["pos"], s["prefix"]) for s in places)
                pos = np.array([s[0] for s in places])
                spot = np.minimum(np.searchsorted(pos, at), len(pos) - 1)
                starts = np.flatnonzero(pos[spot] == at)
                prefixes = np.array([s[1] for s in places], np.int64)[spot[starts]]
                hashes = run_hashes(words, starts, MIN_WORDS).view(np.int64)
                for i in range(0, len(starts), ROWS):
                    n = len(starts[i : i + ROWS])
                    columns = (prefixes[i : i + n], hashes[i : i + n], [doc_id] * n, [text_hash] * n, starts[i : i + n].astype(np.int32))
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return rows.mapInArrow(run, WINDOW)


def window_matches(found: DataFrame) -> DataFrame:
    """The columns of ``matches`` for the windows that another document holds, each with one of the others."""
    place = F.struct(F.xxhash64(*DOC).alias("doc"), *DOC, "start")
    held = found.groupBy("prefix", "window").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a.doc <> b.doc")
    held = stage(held, "shared-windows")
    other = F.when(F.xxhash64(*DOC) == F.col("a.doc"), F.col("b")).otherwise(F.col("a"))
    rows = found.join(held, ["prefix", "window"]).withColumn("other", other)
    end = (F.col("start") + MIN_WORDS).alias("end")
    return rows.select(*DOC, "start", end, F.col("other.doc_id").alias("other_doc_id"), F.col("other.start").alias("other_start"))


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """doc_id, text_hash, start, end, n_words, other_doc_id, other_start: the merged passages of every document that
    has any, with one place where a part of it stands as well."""
    found = stage(suffixes(df, id_col, text_col), "suffixes")
    spots = stage(shared(found), "spots")
    rows = with_surroundings(df, spots, id_col, text_col)
    every = matches(rows, partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    every = every.union(window_matches(stage(windows(df, spots, id_col, text_col), "windows")))
    # Islands of overlapping or touching spans of one document.
    spans = every.groupBy(*DOC, "start", "end").agg(F.min(F.struct("other_doc_id", "other_start")).alias("other"))
    line = Window.partitionBy(*DOC).orderBy("start", "end")
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("reach", reach).withColumn("island", F.sum(F.when(F.col("start") > F.col("reach"), 1).otherwise(0)).over(line))
    merged = spans.groupBy(*DOC, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("other").alias("other"))
    return merged.select(*DOC, "start", "end", (F.col("end") - F.col("start")).cast("long").alias("n_words"), "other.other_doc_id", "other.other_start")
