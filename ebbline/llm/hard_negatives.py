"""Hard negatives of anchors by spanning-tree bounds.

A row takes part if its label and vector are not null and all components are finite numbers. A component x becomes
floor(SCALE * x), computed in doubles (a row where that is infinite takes no part); a shorter vector counts as filled up with zeros. The score of two rows is the inner
product of these integers. Anchors are the rows whose id is divisible by ``every``; rows that share an id, also an anchor's,
stay rows of their own. An anchor's positives are the ``positives`` other rows of its label with the highest scores, its negatives
for a positive of score p the ``negatives`` rows of another label with the highest scores s with LOW * p <= 100 * s <= HIGH * p.
Equal scores are ordered by id, null ids last, then by their place in the table. Without anchors, positives or rows in the window there are no result rows.

Anchors are dealt to blocks of bounded size, and the anchors of a block form a minimum spanning tree. In a task the
root's scores are computed for a bounded block of candidates, then the tree is walked: the score of a candidate x with a child anchor lies
within (edge length) * |x| of its score with the parent, or of the bounds known there. A candidate is scored anew only if these
bounds overlap what is still wanted: for positives the scores above the best ones found so far, for negatives a window, from
below cut at the worst of its best ones found so far. What is wanted only shrinks, so nothing is lost.

All rows are candidates, in STRIPES at most, which are streams: a task holds one block of anchors and one of candidates.
A stripe hands on only its best rows of every anchor; those of all stripes are merged. Scores are exact: they are integers, and
products of doubles are used only where no sum can pass 2^53, Python's integers otherwise; a score beyond 64 bits raises an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ebbline.session import stage

SCALE, LOW, HIGH = 256, 30, 90
EVERY, POSITIVES, NEGATIVES = 100, 5, 10
#: Anchors in a block, candidates that are compared at a time, rows a stripe should hold at least, and stripes at most.
ANCHORS, CANDIDATES, STRIPE_ROWS, STRIPES = 4096, 4096, 2048, 256
EXACT = float(1 << 53)
_NO_ID = (1 << 63) - 1


def quantised(df: DataFrame, id_col: str, vector_col: str, label: str) -> DataFrame:
    """The stored table row, id, label, vector (doubles), norm of the rows that take part. ``label`` is an SQL expression."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.filter(pc.and_(pc.is_valid(batch.column("_vector")), pc.is_valid(batch.column("label"))))
            kept, vectors, norms = [], [], []
            for i, values in enumerate(whole.column("_vector")):
                flat = values.values
                x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
                if flat.null_count or not np.isfinite(x).all():
                    continue
                x = np.floor(SCALE * x)
                if np.isfinite(x).all():
                    kept.append(i)
                    vectors.append(x.astype("<f8").tobytes())
                    norms.append(float(np.sqrt(np.sum(x * x))))
            rows = whole.take(pa.array(kept, pa.int64()))
            yield pa.record_batch([rows.column("row"), rows.column("id"), rows.column("label"), pa.array(vectors, pa.binary()), pa.array(norms, pa.float64())], names=["row", "id", "label", "vector", "norm"])

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.expr(label).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("_vector"))
    return stage(rows.mapInArrow(run, "row long, id long, label long, vector binary, norm double"), "vectors")


def matrix(vectors: list[bytes]) -> np.ndarray:
    """Rows of doubles, filled up with zeros to the longest."""
    size = max(map(len, vectors), default=0)
    return np.frombuffer(b"".join(v.ljust(size, b"\0") for v in vectors), "<f8").reshape(len(vectors), size // 8)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with the vector ``b``, as doubles where they fit, else as Python integers."""
    width = min(a.shape[1], len(b))
    a, b = a[:, :width], b[:width]
    with np.errstate(over="ignore"):
        bound = np.abs(a).max(initial=0) * np.abs(b).sum() if width else 0.0
    if bound < EXACT:
        return a @ b
    whole = [int(x) for x in b]
    return np.array([sum(int(x) * y for x, y in zip(row, whole)) for row in a], object)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent (-1 for the first) and edge length of every row in a minimum spanning tree, grown from row 0."""
    n = len(vectors)
    parent, length = np.full(n, -1, np.int64), np.zeros(n)
    best, left = np.full(n, np.inf), np.ones(n, bool)
    at = 0
    for _ in range(n - 1):
        left[at] = False
        gap = vectors - vectors[at]
        d = np.sqrt((gap * gap).sum(axis=1))
        closer = left & (d < best)
        best[closer], parent[closer] = d[closer], at
        at = int(np.argmin(np.where(left, best, np.inf)))
        length[at] = best[at]
    return parent, length


class Block:
    """Anchors of one block and, for each, what its search still wants."""

    def __init__(self, rows: list[tuple]) -> None:
        self.rows = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([r[1] for r in rows], np.int64)
        self.vectors = matrix([r[2] for r in rows])
        self.parent, self.length = spanning_tree(self.vectors)
        self.children: list[list[int]] = [[] for _ in rows]
        for child, parent in enumerate(self.parent):
            if parent >= 0:
                self.children[parent].append(child)
        weight = np.ones(len(rows), np.int64)
        for x in self.below()[::-1]:
            if self.parent[x] >= 0:
                weight[self.parent[x]] += weight[x]
        for kids in self.children:  # the largest subtree last: then few bounds are held at a time
            kids.sort(key=lambda c: weight[c])

    def below(self) -> list[int]:
        """Anchors, each before its children."""
        order, todo = [], [0] if len(self.rows) else []
        while todo:
            x = todo.pop()
            order.append(x)
            todo += self.children[x]
        return order

    def walk(self, vectors: np.ndarray, norms: np.ndarray, wanted: Callable) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For every anchor the candidates that may be wanted, and their exact scores. ``wanted(anchor, low, high)`` marks the
        candidates whose scores, known to lie between ``low`` and ``high``, the anchor still wants."""
        if not len(self.rows):
            return
        open_bounds = np.full(len(norms), np.inf)
        todo = [(0, -open_bounds, open_bounds)]
        while todo:
            x, low, high = todo.pop()
            reach = self.length[x] * norms
            slack = 1e-9 * (reach + np.abs(low) + 1)  # the bounds are rounded, the scores are not
            low, high = low - reach - slack, high + reach + slack
            at = np.flatnonzero(wanted(x, low, high)) if self.parent[x] >= 0 else np.arange(len(norms))
            if len(at):
                exact = products(vectors[at], self.vectors[x])
                yield x, at, exact
                low[at] = high[at] = exact.astype(float)
            todo += [(child, low, high) for child in reversed(self.children[x])]  # the first child is popped first


def best_of(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, equal ones by id."""
    return np.lexsort((ids, -scores))[:n] if scores.dtype != object else np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:n], np.int64)


def _worst(kept: tuple | None, n: int):
    """Scores below this can't be among the best ``n`` any more."""
    return kept[0][-1] if kept is not None and len(kept[0]) == n else -math.inf


def _merge(kept: tuple | None, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, n: int) -> tuple:
    if kept is not None:
        scores, ids, rows = (np.concatenate([a, b]) for a, b in zip(kept, (scores, ids, rows)))
    at = best_of(scores, ids, n)
    return scores[at], ids[at], rows[at]


def _in_cells(vectors: DataFrame, anchors: DataFrame, make: Callable, schema: str) -> DataFrame:
    """Every block of ``anchors`` (row, label, vector, extra) meets every stripe of ``vectors``. Tasks get the anchors of a cell first, then
    its candidates in order. ``make(anchors)`` gives the search of a cell."""
    n, m = vectors.count(), anchors.count()
    blocks = max(1, -(-m // ANCHORS))
    stripes = max(1, min(STRIPES, -(-n // STRIPE_ROWS)))
    up_to = lambda k: F.sequence(F.lit(0), F.lit(k - 1))
    block = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(blocks)).cast("int")
    stripe = F.pmod(F.xxhash64(F.lit(2), "row"), F.lit(stripes)).cast("int")
    none = F.lit(None)
    heads = anchors.select(block.alias("block"), F.explode(up_to(stripes)).alias("stripe"), F.lit(0).alias("role"), "row", none.cast("long").alias("id"), "label", "vector", none.cast("double").alias("norm"), "extra")
    tails = vectors.select(F.explode(up_to(blocks)).alias("block"), stripe.alias("stripe"), F.lit(1).alias("role"), "row", "id", "label", "vector", "norm", none.cast("array<long>").alias("extra"))
    cells = heads.unionByName(tails).repartition(blocks * stripes, "block", "stripe").sortWithinPartitions("block", "stripe", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, heads, held, search = None, [], [], None

        def compare() -> None:
            nonlocal search, held
            if search is None:
                search = make(heads)
            if held:
                ids = np.array([_NO_ID if r[1] is None else r[1] for r in held], np.int64)
                search.take(matrix([r[3] for r in held]), np.array([r[4] for r in held]), ids, np.array([r[2] for r in held], np.int64), np.array([r[0] for r in held], np.int64))
            held = []

        for batch in batches:
            for block, stripe, role, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "stripe", "role", "row", "id", "label", "vector", "norm", "extra"))):
                if cell != (block, stripe):
                    if cell is not None:
                        compare()
                        yield from search.found()
                    cell, heads, held, search = (block, stripe), [], [], None
                if role == 0:
                    heads.append((row[0], row[2], row[3], row[5]))
                else:
                    held.append(row)
                    if len(held) == CANDIDATES:
                        compare()
        if cell is not None:
            compare()
            yield from search.found()

    return cells.mapInArrow(run, schema)


class PositiveSearch:
    def __init__(self, anchors: list[tuple], n: int) -> None:
        self.block, self.n = Block(anchors), n
        self.best: list[tuple | None] = [None] * len(anchors)

    def take(self, vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        block = self.block

        def wanted(x: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            mine = (labels == block.labels[x]) & (rows != block.rows[x])
            floor = _worst(self.best[x], self.n)
            lows = low[mine]
            if len(lows) > self.n:  # so many score at least this
                floor = max(floor, np.partition(lows, len(lows) - self.n)[len(lows) - self.n])
            return mine & (high >= floor)

        for x, at, scores in block.walk(vectors, norms, wanted):
            mine = (labels[at] == block.labels[x]) & (rows[at] != block.rows[x])
            if mine.any():
                self.best[x] = _merge(self.best[x], scores[mine], ids[at][mine], rows[at][mine], self.n)

    def found(self) -> Iterator[pa.RecordBatch]:
        out = [(int(self.block.rows[x]), int(s), int(i), int(r)) for x, kept in enumerate(self.best) if kept is not None for s, i, r in zip(*kept)]
        yield pa.record_batch([pa.array([o[k] for o in out], pa.int64()) for k in range(4)], names=["anchor", "score", "id", "other"])


class NegativeSearch:
    """The windows of an anchor lie between ceil(LOW * p / 100) and floor(HIGH * p / 100) for its positive scores p."""

    def __init__(self, anchors: list[tuple], n: int) -> None:
        self.block, self.n = Block([a[:3] for a in anchors]), n
        self.windows = [[(-(-LOW * int(p) // 100), HIGH * int(p) // 100) for p in a[3]] for a in anchors]
        self.best: list[list[tuple | None]] = [[None] * len(w) for w in self.windows]

    def take(self, vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        block = self.block

        def wanted(x: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            other = labels != block.labels[x]
            out = np.zeros(len(ids), bool)
            for (start, end), kept in zip(self.windows[x], self.best[x]):
                if start <= end:
                    floor = max(start, _worst(kept, self.n))
                    sure = low[other & (low >= floor) & (high <= end)]
                    if len(sure) > self.n:
                        floor = max(floor, np.partition(sure, len(sure) - self.n)[len(sure) - self.n])
                    out |= (high >= floor) & (low <= end)
            return out & other

        for x, at, scores in block.walk(vectors, norms, wanted):
            other = labels[at] != block.labels[x]
            at, scores = at[other], scores[other]
            for j, (start, end) in enumerate(self.windows[x]):
                inside = np.flatnonzero(((scores >= max(start, _worst(self.best[x][j], self.n))) & (scores <= end)).astype(bool))
                if len(inside):
                    self.best[x][j] = _merge(self.best[x][j], scores[inside], ids[at[inside]], rows[at[inside]], self.n)

    def found(self) -> Iterator[pa.RecordBatch]:
        out = [(int(self.block.rows[x]), j, int(s), int(i), int(r)) for x, kept in enumerate(self.best) for j, one in enumerate(kept) if one is not None for s, i, r in zip(*one)]
        yield pa.record_batch([pa.array([o[k] for o in out], pa.int32() if k == 1 else pa.int64()) for k in range(5)], names=["anchor", "place", "score", "id", "other"])


def hard_negatives(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: str = "label", every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    vectors = quantised(df, id_col, vector_col, label)
    anchors = vectors.where(F.col("id") % every == 0)

    def top(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "other")
        return rows.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= n)

    bare = anchors.select("row", "label", "vector", F.lit(None).cast("array<long>").alias("extra"))
    near = _in_cells(vectors, bare, lambda rows: PositiveSearch([r[:3] for r in rows], positives), "anchor long, score long, id long, other long")
    chosen = stage(top(near, ["anchor"], positives), "positives")
    windows = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    with_windows = anchors.join(windows, anchors["row"] == windows["anchor"]).select("row", "label", "vector", F.col("p.score").alias("extra"))
    hard = _in_cells(vectors, with_windows, lambda rows: NegativeSearch(rows, negatives), "anchor long, place int, score long, id long, other long")
    hard = top(hard, ["anchor", "place"], negatives)
    named = F.when(F.col("id") != _NO_ID, F.col("id"))
    pairs = chosen.select("anchor", (F.col("rank") - 1).alias("place"), named.alias("positive_id"), F.col("score").alias("positive_score"))
    out = hard.select("anchor", "place", "rank", named.alias("negative_id"), F.col("score").alias("negative_score")).join(pairs, ["anchor", "place"])
    ids = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return out.join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
