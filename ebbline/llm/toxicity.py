"""Toxicity by a string-kernel support vector machine with Nyström landmarks.

The kernel of two strings sums, over all subsequences of three characters, the product of their weights in either; an
occurrence that stretches over s characters weighs DECAY ** s, so characters that are inserted or left out only dampen it. Occurrences
longer than SPAN count nothing, strings longer than PIECE are taken in overlapping pieces.

A text is a bag of sentences and these a bag of words; words are runs without ASCII white space, lower-cased, of letters and digits only,
and single characters in a row ("i d i o t") make one word; marks stand at either end of a word. The value of a landmark z for a word w is
K(w, z) / K(z, z), where no subsequence of w weighs more than it does in z; below FLOOR, which is less than an insult reaches with a character
inserted in each of its gaps, it counts as 0. For a text, three values of each landmark are taken: the largest square over its distinct words, the logarithm of the sum
of squares, and that sum over the root of the number of distinct words (the kernel of the text as a bag, normalised by its length, so that one chance hit in a long text tells little);
the last two also of all landmarks together. Landmarks are the words and word beginnings that tell toxic training texts best from the others,
chosen so that every toxic text is covered several times. With the kernel matrix M of the landmarks, k(text) M^(-1/2) is the
Nyström map (of each of the three); a linear squared-hinge machine is trained on it and its margin turned into a probability by a
logistic fit. Texts that these leave bare get landmarks of their own, however rare; only a fragment of a single toxic text, which nothing tells from chance, is
taken just where no other stands in two.

Training uses labels whose crc32(doc_id as text) mod 5 is not 0, at most TRAIN_ROWS a class in the order of a hash of the id,
whole texts; nothing but the text enters a score. Of several labels of an id the largest counts, null labels are left out.
Without training texts of both classes, or without any fragment that tells them apart, every score is the share of toxic ones among all usable labels (0 without any). Null and empty texts
have the score of a text without words. Repeated rows and null ids (not held out) are kept; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbline.llm.common import bounded, map_batches, slices, small_batches, texts_of, without_rows
from ebbline.session import stage

DECAY, SPAN, PIECE, STRIDE = 0.6, 7, 18, 9
FLOOR = 0.25
LANDMARKS = 256
TRAIN_ROWS = 2000
#: Toxic training texts that must hold a fragment, and how many times the share of the others.
LEAST_TEXTS, CONTRAST = 2, 4
CANDIDATES = 1500
COVER = 4
#: A landmark worth less for each toxic training text is only taken for texts that no other covers.
LEAST_GAIN = 0.02
PENALTY = 0.001
SEEN_WORDS = 300_000
#: Bytes of text whose words are held at a time while texts are scored: a worker keeps what it once took from the system.
SCORED_BYTES = 1 << 20
#: The same of the sample's texts, whose fragments are many times their words.
SAMPLED_BYTES = 1 << 18
#: Words whose values are held, and words evaluated, at a time.
WORDS_AT_ONCE, CHUNK = 2048, 512
#: Triples of words that meet all landmarks at a time.
TRIPLES_AT_ONCE = 8192
ALPHABET = 64

_SINGLES = re.compile(rb"(?:(?<=\s)|^)(?:[A-Za-z0-9][.,*_-]?[ ]+){2,}[A-Za-z0-9](?![A-Za-z0-9])")
_NO_SIGNS = re.compile(r"[\W_]+")


def words_of(text: bytes) -> set[bytes]:
    """The distinct runs of a text, and the words that single characters in a row make."""
    found = set(text.split())
    for m in _SINGLES.finditer(text):
        found.add(re.sub(rb"[^A-Za-z0-9]", b"", m[0]))
    return found


def normal(word: bytes) -> str:
    """Lower case without signs, between the marks of its beginning and end."""
    return f"^{_NO_SIGNS.sub('', word.decode('utf-8', 'replace').lower())}$"


def coded(word: str) -> np.ndarray:
    """Character classes below ALPHABET: a-z, 0-9 and the marks of a word's ends have their own, others share."""
    points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = (points >= 97) & (points <= 122)
    digit = (points >= 48) & (points <= 57)
    other = 38 + points % (ALPHABET - 38)
    return np.where(letter, points - 97, np.where(digit, points - 22, np.where(points == 94, 36, np.where(points == 36, 37, other))))


def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the triples in a string of this length and their weights."""
    spots = [t for t in itertools.combinations(range(length), 3) if t[2] - t[0] < SPAN]
    at = np.array(spots, np.int64).reshape(-1, 3)
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)


TRIPLES = {n: _triples(n) for n in range(3, PIECE + 1)}


def subsequences(word: str) -> dict[int, float]:
    """Weight of every triple of a word of at most PIECE characters."""
    out: dict[int, float] = {}
    codes = coded(word)
    if len(codes) >= 3:
        at, weights = TRIPLES[len(codes)]
        triples = codes[at]
        for key, weight in zip((triples[:, 0] * ALPHABET + triples[:, 1]) * ALPHABET + triples[:, 2], weights):
            out[int(key)] = out.get(int(key), 0.0) + float(weight)
    return out


def pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - PIECE + STRIDE, STRIDE)]


@dataclass
class Kernel:
    """Values of words for a set of landmarks. ``own`` holds the weights of their triples, ``weights`` the same over K(z, z)."""

    landmarks: list[str]
    rows: np.ndarray = field(init=False)
    weights: np.ndarray = field(init=False)
    own: np.ndarray = field(init=False)
    gram: np.ndarray = field(init=False)
    most: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        own = [subsequences(z) for z in self.landmarks]
        keys = {key: i for i, key in enumerate(sorted({k for o in own for k in o}))}
        # the row of `weights` that belongs to a triple; the last row is empty
        self.rows = np.full(ALPHABET**3, len(keys), np.int32)
        self.weights = np.zeros((len(keys) + 1, len(own)), np.float32)
        for z, o in enumerate(own):
            for key, weight in o.items():
                self.rows[key] = keys[key]
                self.weights[keys[key], z] = weight
        self.gram = self.weights.T.astype(float) @ self.weights
        self.own = self.weights.copy()
        self.weights /= np.maximum(np.diag(self.gram), 1e-12).astype(np.float32)
        self.most = self.weights.max(axis=1)

    def values(self, words: Sequence[str]) -> np.ndarray:
        """One row per word: K(w, z) / K(z, z) with weights cut at those of z, 0 below FLOOR."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        by_length: dict[int, list[tuple[int, str]]] = {}
        for i, word in enumerate(words):
            for piece in pieces(word):
                if len(piece) >= 3:
                    by_length.setdefault(len(piece), []).append((i, piece))
        empty = len(self.weights) - 1
        for length, group in by_length.items():
            at, weight = TRIPLES[length]
            for first in range(0, len(group), CHUNK):
                part = group[first : first + CHUNK]
                codes = coded("".join(p for _, p in part)).reshape(len(part), length)
                rows = self.rows[(codes[:, at[:, 0]] * ALPHABET + codes[:, at[:, 1]]) * ALPHABET + codes[:, at[:, 2]]]
                which, triple = np.nonzero(rows != empty)
                if not len(which):
                    continue
                # a bound first: no landmark gets more than the largest weight of each triple
                high = np.bincount(which, weight[triple] * self.most[rows[which, triple]], len(part))
                keep = high[which] >= FLOOR
                which, triple = which[keep], triple[keep]
                if not len(which):
                    continue
                spots, inverse = np.unique(which * (empty + 1) + rows[which, triple], return_inverse=True)
                got = np.bincount(inverse, weight[triple]).astype(np.float32)  # weight of each triple in its piece
                which, row = np.divmod(spots, empty + 1)
                starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
                ids = np.array([part[w][0] for w in which[starts]])
                ends = np.r_[starts[1:], len(row)]
                for words_of_part in np.array_split(np.arange(len(starts)), len(row) // TRIPLES_AT_ONCE + 1):
                    first, last = starts[words_of_part[0]], ends[words_of_part[-1]]
                    some = row[first:last]
                    total = np.add.reduceat(np.minimum(got[first:last, None], self.own[some]) * self.weights[some], starts[words_of_part] - first)
                    np.maximum.at(out, ids[words_of_part], total)
        out[out < FLOOR] = 0
        return out


class TextKernel:
    """Values of whole texts; words are remembered, those near a landmark with the numbers of such landmarks and their values."""

    def __init__(self, kernel: Kernel) -> None:
        self.kernel = kernel
        self.near: dict[bytes, tuple[bytes, bytes]] = {}
        self.far: set[bytes] = set()

    def values(self, texts: Sequence[bytes]) -> np.ndarray:
        bags = [words_of(t) for t in texts]
        bounded(self.far, SEEN_WORDS)
        bounded(self.near, SEEN_WORDS)
        fresh = list(set().union(*bags).difference(self.far, self.near)) if bags else []
        for i in range(0, len(fresh), WORDS_AT_ONCE):
            part = fresh[i : i + WORDS_AT_ONCE]
            found = self.kernel.values([normal(w) for w in part])
            for word, row in zip(part, found):
                at = np.flatnonzero(row)
                if len(at):
                    self.near[word] = at.astype(np.int32).tobytes(), row[at].tobytes()
                else:
                    self.far.add(word)
        size = len(self.kernel.landmarks)
        out = np.zeros((len(texts), 3 * size + 2), np.float32)
        for i, bag in enumerate(bags):
            hits = [self.near[w] for w in bag if w in self.near]
            if hits:
                squares = np.zeros((len(hits), size), np.float32)
                for row, (at, value) in zip(squares, hits):
                    row[np.frombuffer(at, np.int32)] = np.frombuffer(value, np.float32)
                np.square(squares, out=squares)  # what is only half alike counts a quarter
                sums = np.sum(squares, axis=0)
                total, length = sums.sum(), math.sqrt(len(bag))
                out[i, :size] = np.max(squares, axis=0)
                out[i, size : 2 * size] = np.log1p(sums) / 4
                out[i, 2 * size : -2] = np.minimum(sums / length, 1)
                out[i, -2:] = np.log1p(total) / 2, total / length
        return out


@dataclass
class Model:
    kernel: Kernel | None
    alpha: np.ndarray
    bias: float
    slope: float
    offset: float
    #: The score of every text if there is no kernel.
    share: float = 0.0

    def score(self, values: np.ndarray) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(values), self.share)
        margin = values @ self.alpha + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def fragments(word: str) -> list[str]:
    """A marked word and its beginnings, as candidates for landmarks."""
    return [word[:n] for n in range(4, 9) if n < len(word) - 1] + ([word] if 5 <= len(word) <= PIECE else [])


def training_labels(labels: DataFrame) -> DataFrame:
    """_l (the id) and toxic of the ids that are not held out."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return usable.groupBy(F.col("doc_id").cast("long").alias("_l")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def training_rows(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text and toxic of at most ``rows`` labelled texts of each class, none of them held out."""
    one = training_labels(labels)
    order = F.xxhash64("_l")
    # the first rows of each class, found without a task that holds a class
    chosen = one.where("toxic = 1").orderBy(order, "_l").limit(rows).union(one.where("toxic = 0").orderBy(order, "_l").limit(rows))
    docs = documents.select(F.col(id_col).cast("long").alias("_d"), F.col(text_col).cast("string").alias("_text"))
    return docs.join(F.broadcast(chosen), F.col("_d") == F.col("_l")).select(F.col("_d").alias("_id"), "_text", "toxic").dropDuplicates(["_id"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def choose_landmarks(sample: DataFrame, counts: dict[int, int], most: int = LANDMARKS) -> list[str]:
    """Fragments with the best log odds, greedily by the toxic texts they cover, each up to COVER times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, most=SAMPLED_BYTES)):
            ids, parts, toxic = [], [], []
            for doc_id, text, label in zip(batch.column("_id").to_pylist(), texts_of(batch, "_text"), batch.column("toxic").to_pylist()):
                found = {f for w in words_of(text) for f in fragments(normal(w))}
                ids += [doc_id] * len(found)
                toxic += [label] * len(found)
                parts += found
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(parts, pa.string()), pa.array(toxic, pa.int32())], names=["_id", "part", "toxic"])

    spots = sample.mapInArrow(run, "_id long, part string, toxic int")
    share = lambda label: F.sum((F.col("toxic") == label).cast("long")) / max(counts.get(label, 0), 1)
    weight = F.col("t") * F.log((F.col("t") + 1e-3) / (F.col("c") + 1e-3))
    best = spots.groupBy("part").agg(share(1).alias("t"), share(0).alias("c"), F.sum("toxic").alias("n"))
    best = best.where((F.col("n") > 0) & (F.col("t") > CONTRAST * F.col("c"))).withColumn("weight", weight)
    best = stage(best, "toxicity-fragments")
    if best.where(F.col("n") >= LEAST_TEXTS).count():
        best = best.where(F.col("n") >= LEAST_TEXTS)
    # the best fragments of all, and the best of every toxic text
    top = best.orderBy(F.desc("weight"), "part").limit(CANDIDATES).select("part")
    held = spots.where("toxic = 1").select("part", "_id").join(best, "part")
    rank = F.row_number().over(Window.partitionBy("_id").orderBy(F.desc("weight"), "part"))
    wanted = top.union(held.withColumn("rank", rank).where(F.col("rank") <= COVER).select("part")).distinct()
    holders: dict[str, set[int]] = {}
    rated: dict[str, float] = {}
    for r in held.join(wanted, "part", "left_semi").select("part", "_id", "t", "c").collect():
        holders.setdefault(r.part, set()).add(r["_id"])
        rated[r.part] = math.log((r.t + 1e-3) / (r.c + 1e-3))
    covered: dict[int, int] = {}
    chosen: list[str] = []
    bare = False  # from now on for texts without a landmark only
    while len(chosen) < most and holders:
        full = 1 if bare else COVER
        gain = lambda p: rated[p] * sum(1 / (1 + covered.get(i, 0)) for i in holders[p] if covered.get(i, 0) < full)
        part = max(sorted(holders), key=lambda p: (gain(p), len(p)))  # of equal ones the most specific
        if not bare and gain(part) < LEAST_GAIN * counts.get(1, 0):
            bare = True
            holders = {p: ids for p, ids in holders.items() if not all(i in covered for i in ids)}
            continue
        if gain(part) <= 0:
            break
        chosen.append(part)
        for i in holders.pop(part):
            covered[i] = covered.get(i, 0) + 1
        # the same word
        holders = {p: ids for p, ids in holders.items() if not (p.startswith(part) or part.startswith(p)) and not (bare and all(i in covered for i in ids))}
    return chosen


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights and, last, the bias of the linear machine, by Newton steps over the texts inside the margin."""
    a = np.c_[x, np.ones(len(x))]
    ridge = np.eye(a.shape[1]) * penalty
    ridge[-1, -1] = 1e-8
    w = np.zeros(a.shape[1])
    for _ in range(50):
        inside = y * (a @ w) < 1
        part, c = a[inside], weight[inside]
        new = np.linalg.solve(ridge + (part * c[:, None]).T @ part, (part * c[:, None]).T @ y[inside])
        step = 1.0
        loss = lambda v: v @ ridge @ v + (weight * np.maximum(0, 1 - y * (a @ v)) ** 2).sum()
        while step > 1e-4 and loss(w + step * (new - w)) > loss(w) + 1e-15:
            step /= 2
        if np.abs(new - w).max() * step < 1e-10:
            break
        w = w + step * (new - w)
    return w


def logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, with targets drawn in from 0 and 1."""
    up, down = (y > 0).sum(), (y < 0).sum()
    goal = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = np.c_[margin, np.ones(len(margin))], np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -500, 500)))
        h = (a * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ a + np.eye(2) * 1e-6
        step = np.linalg.solve(h, a.T @ (goal - p) - 1e-6 * b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    sample = stage(training_rows(documents, labels, rows, id_col, text_col), "toxicity-sample")
    counts = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    labelled = {r.toxic: r["count"] for r in training_labels(labels).groupBy("toxic").count().collect()}
    chosen = choose_landmarks(sample, counts, landmarks) if len(counts) == 2 else []
    if not chosen:
        # not that of the sample, which holds as many of either class
        share = labelled.get(1, 0) / max(sum(labelled.values()), 1)
        return Model(None, np.zeros(0), 0.0, 0.0, 0.0, share)
    kernel = Kernel(chosen)

    def make(batch):
        return {"id": batch.column("_id"), "toxic": batch.column("toxic"), "k": TextKernel(kernel).values(texts_of(batch, "_text")).tolist()}

    found = sorted(map_batches(sample, make, "id long, toxic int, k array<float>", SAMPLED_BYTES).collect())
    x = np.array([r.k for r in found], float)
    y = np.array([2.0 * r.toxic - 1 for r in found])
    # K_ij / sqrt(K_ii K_jj); its inverse square root is the Nyström map
    scale = np.sqrt(np.diag(kernel.gram))
    values, vectors = np.linalg.eigh(kernel.gram / np.outer(scale, scale))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0.05))) @ vectors.T
    per_class = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    mapping = np.eye(x.shape[1])  # the three values are mapped alike, those of all landmarks stay
    mapping[:-2, :-2] = np.kron(np.eye(3), root)
    w = squared_hinge(x @ mapping, y, per_class)
    alpha, bias = mapping @ w[:-1], float(w[-1])
    slope, offset = logistic(x @ alpha + bias, y)
    # the sample has other shares of the classes than the labels
    offset += math.log(labelled[1] / labelled[0]) - math.log((y > 0).sum() / (y < 0).sum())
    return Model(kernel, alpha, bias, slope, offset)


def score_texts(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, held_out, score and predicted of every row."""
    text = F.col(text_col).cast("string")
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"), F.xxhash64(text).alias("text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = TextKernel(model.kernel) if model.kernel is not None else None
        for batch in (part for whole in batches for part in slices(whole, most=SCORED_BYTES)):
            values = texts.values(texts_of(batch, "_text")) if texts is not None else np.zeros((batch.num_rows, len(model.alpha)))
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(model.score(values).astype(float))], names=["doc_id", "text_hash", "score"])

    scored = rows.mapInArrow(run, "doc_id long, text_hash long, score double")
    return scored.select("doc_id", "text_hash", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score_texts(documents, train(documents, labels))


def clean_rows(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` that are not predicted toxic, with their columns."""
    with small_batches(documents.sparkSession):
        model = train(documents, labels, id_col=id_col, text_col=text_col)
        toxic = score_texts(documents, model, id_col, text_col).where("predicted = 1").select("doc_id", "text_hash")
        toxic = stage(toxic, "toxic")
    return without_rows(documents, toxic, id_col, text_col)
