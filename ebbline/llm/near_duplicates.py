"""MinHash near duplicates by a multi-index Hamming join.

Words: A-Z lower-cased, then maximal runs without ASCII white space. A document's set holds the distinct shingles of five
consecutive words, of a shorter text the whole sequence; a text without words has an empty set and is linked with
nothing. Two documents are linked if 100 * intersection >= 75 * union, confirmed on the full sets of the texts.

Documents with equal sets form a class; from here on classes are compared. The signature of a class is SYMBOLS minima of
hashed shingles, BITS bits each; two sets of similarity J differ in about (1 - J) * SYMBOLS symbols. The join returns every
pair of signatures that differ in at most RADIUS symbols: they are cut into CHUNKS chunks, and by the pigeonhole
principle some chunk of such a pair differs in at most ERRORS symbols, so the pair agrees in one of the keys made by
leaving ERRORS symbols out of a chunk. At similarity 0.75 a pair lies outside RADIUS with a probability of 3e-6. What
shares a key is then measured by WIDE more minima of 4 bits; there, WIDE_RADIUS loses a pair with a probability of 1e-6. Last, the
parities of the shingles' numbers in PARITIES parts of their space are compared: where they differ, a shingle is in one set only, so
pairs that differ in too many for the similarity are ruled out for certain, most of those just below it in texts of some hundred words.

Large buckets are never paired in full. First every member of a bucket is compared with the bucket's least class;
confirmed links join classes to components. A pair inside one component needs no further test. Only buckets that still hold
several components go on: their members are dealt in blocks to cells of bounded size, where signatures of different components are
compared. As long as that finds links, every class proposes its nearest one of another component only, in one of PARTS parts of the
keys a round: so few pairs join nearly all of a large group. In the last round all pairs within the radii whose classes are still in
different components are confirmed on the texts, each proposed in the least key that it shares. So the components are those of all links.

A row's component_id is the least doc_id reachable (null ids are never the least), kept says that it is the row's own. Repeated
rows are copies of each other. Null ids are kept; a group of null ids only has a null component. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType
from xxhash import xxh64_intdigest

from ebbline.llm.common import map_batches, quoted, slices, small_batches, texts_of, unused
from ebbline.session import stage

SHINGLE = 5
PERCENT = 75
SYMBOLS, BITS = 40, 16
WIDE, WIDE_RADIUS = 512, 166
PARITIES = 1024
CHUNKS, ERRORS = 8, 2
#: The largest distance that the pigeonhole principle covers.
RADIUS = CHUNKS * (ERRORS + 1) - 1
#: Members of a bucket in a block, and links of one class that are confirmed together.
BLOCK, LINKS = 512, 200
MAX_ROUNDS = 60
#: Rounds of nearest partners at most, and parts into which their keys are cut.
NEAREST, PARTS = 12, 16
#: Bits of the summary that keeps texts nobody asks for out of a shuffle: 1 MB whatever the input.
FILTER_BITS = 1 << 23
#: Classes whose keys are sent back together.
KEYED = 1024

_random = np.random.default_rng(20240229)
_PLACES = _random.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _random.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_WIDE_FACTORS = _random.integers(0, 1 << 31, WIDE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_WIDE_SHIFTS = _random.integers(0, 1 << 32, WIDE, dtype=np.uint32)
#: How many of the two symbols in a byte are not 0.
_DIFFERENT = np.array([(b & 15 > 0) + (b >> 4 > 0) for b in range(256)], np.uint8)
SIG_BYTES = 2 * SYMBOLS
WIDE_END = SIG_BYTES + WIDE // 2
PARITY_END = WIDE_END + PARITIES // 8


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of the shingles."""
    words = text.lower().split()  # bytes: only A-Z and ASCII white space count
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, n)
    size = min(n, SHINGLE)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total += hashes[i : n - size + 1 + i] * _PLACES[i]
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """SYMBOLS numbers of BITS bits; at least one shingle."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        part = shingles[None, i : i + 4096] * _FACTORS[:, None] + _SHIFTS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (_mix(least) >> np.uint64(64 - BITS)).astype(np.uint16)


def wide_signature(shingles: np.ndarray) -> np.ndarray:
    """WIDE numbers of 4 bits, two to a byte."""
    least = np.full(WIDE, np.iinfo(np.uint32).max, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 512):
        part = short[None, i : i + 512] * _WIDE_FACTORS[:, None] + _WIDE_SHIFTS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    bits = ((least * np.uint32(0x9E3779B1)) >> np.uint32(28)).astype(np.uint8)
    return bits[::2] | bits[1::2] << 4


def parities(shingles: np.ndarray) -> np.ndarray:
    """PARITIES bits: whether the number of shingles in a part of their space is odd."""
    counts = np.bincount((shingles >> np.uint64(32)).astype(np.int64) % PARITIES, minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8))


def full_signature(shingles: np.ndarray) -> bytes:
    return signature(shingles).tobytes() + wide_signature(shingles).tobytes() + parities(shingles).tobytes() + np.uint32(len(shingles)).tobytes()


def sig_parts(values) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The matrices of both signatures, and of the parities with the size of the set."""
    all_bytes = np.frombuffer(b"".join(values), np.uint8).reshape(-1, PARITY_END + 4)
    return np.ascontiguousarray(all_bytes[:, :SIG_BYTES]).view(np.uint16), all_bytes[:, SIG_BYTES:WIDE_END], all_bytes[:, WIDE_END:]


def may_be_similar(odds: np.ndarray, others: np.ndarray) -> np.ndarray:
    """False where the parities (with the size) alone show that two sets are less similar than PERCENT: a part with different parities
    holds at least one shingle of one set only."""
    size = lambda m: np.ascontiguousarray(m[:, PARITIES // 8 :]).view(np.uint32)[:, 0].astype(np.int64)
    apart = np.bitwise_count(odds[:, : PARITIES // 8] ^ others[:, : PARITIES // 8]).sum(axis=1, dtype=np.int64)
    return (100 + PERCENT) * apart <= (100 - PERCENT) * (size(odds) + size(others))


def distances(sigs: np.ndarray, wides: np.ndarray, odds: np.ndarray, sig: np.ndarray, wide: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Distances of the wide signatures, of one row or as many; beyond either radius or ruled out by the parities, WIDE + 1."""
    far = np.full(len(sigs), WIDE + 1, np.int32)
    near = np.flatnonzero((sigs != sig).sum(axis=1) <= RADIUS)
    if len(near):
        d = _DIFFERENT[wides[near] ^ (wide[near] if len(wide) > 1 else wide)].sum(axis=1, dtype=np.int32)
        close = (d <= WIDE_RADIUS) & may_be_similar(odds[near], odd[near] if len(odd) > 1 else odd)
        far[near] = np.where(close, d, WIDE + 1)
    return far


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def signatures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored table row, doc_id, text_hash, n_shingles, set_id, sig of every row; set_id and sig are null for empty sets."""

    def make(batch):
        out: dict[str, list] = {"n_shingles": [], "set_id": [], "sig": []}
        for text in texts_of(batch, "_text"):
            shingles = shingle_set(text)
            out["n_shingles"].append(len(shingles))
            out["set_id"].append(hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest() if len(shingles) else None)
            out["sig"].append(full_signature(shingles) if len(shingles) else None)
        return {"row": batch.column("_row"), "doc_id": batch.column("_id"), "text_hash": batch.column("_hash")} | out

    text = F.col(text_col).cast("string")
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_hash"))
    return stage(map_batches(rows, make, "row long, doc_id long, text_hash long, n_shingles long, set_id string, sig binary"), "signatures")


def chunk_keys(sigs: np.ndarray) -> np.ndarray:
    """All keys of each signature (rows of SYMBOLS numbers): one per chunk and choice of ERRORS symbols left out."""
    size = SYMBOLS // CHUNKS
    picks = list(itertools.combinations(range(size), size - ERRORS))
    keys = np.empty((len(sigs), CHUNKS * len(picks)), np.int64)
    wide = sigs.astype(np.uint64)
    for c in range(CHUNKS):
        for p, pick in enumerate(picks):
            key = np.full(len(sigs), c * len(picks) + p + 1, np.uint64)
            for i in pick:
                key = _mix(key * np.uint64(0xD6E8FEB86659FD93) + wide[:, c * size + i])
            keys[:, c * len(picks) + p] = key.view(np.int64)
    return keys


def key_rows(classes: DataFrame) -> DataFrame:
    """key, class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, KEYED) for i in range(0, whole.num_rows, KEYED)):
                keys = chunk_keys(sig_parts(batch.column("sig").to_pylist())[0])
                ids = np.repeat(batch.column("class").to_numpy(zero_copy_only=False), keys.shape[1])
                yield pa.record_batch([pa.array(keys.ravel()), pa.array(ids)], names=["key", "class"])

    return classes.select("class", "sig").mapInArrow(run, "key long, class long")


@F.pandas_udf(BooleanType())
def near(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=bool)
    return pd.Series(distances(*sig_parts(a), *sig_parts(b)) <= WIDE_RADIUS)


def asked_for(routes: DataFrame):
    """A filter on the hash of a document's address that lets pass every document of ``routes`` and few others. It is a
    bitmap of FILTER_BITS bits, built by Spark and sent to the tasks."""
    spot = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(FILTER_BITS)) + 1
    maps = routes.select(spot.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    found = np.zeros(FILTER_BITS, bool)
    for r in maps.collect():
        bits = np.unpackbits(np.frombuffer(bytes(r.m), np.uint8), bitorder="little")
        found[(r.n - 1) * len(bits) : r.n * len(bits)] = bits
    packed = np.packbits(found)

    @F.pandas_udf(BooleanType())
    def passes(h: pd.Series) -> pd.Series:
        at = h.to_numpy(np.int64) % FILTER_BITS
        return pd.Series((packed[at >> 3] >> (7 - (at & 7)) & 1).astype(bool))

    return passes


def confirm(pairs: DataFrame, classes: DataFrame, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The stored pairs (a, b) whose full sets are similar enough.

    Texts are fetched by id and hash and sent to the pair's first class, LINKS at a time: a class with many links is
    dealt to as many tasks as it needs, each of which gets its text once.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / LINKS).cast("int").alias("parts"))
    members = pairs.join(degree, "a").select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.col("b").alias("class"), F.lit(1).alias("role"))
    heads = degree.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("class"), F.lit(0).alias("role"))
    routes = stage(members.unionByName(heads).join(classes.select("class", "doc_id", "text_hash"), "class"), "routes")
    text = F.col(text_col).cast("string")
    docs = df.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    docs = docs.where(asked_for(routes)(F.xxhash64("_id", "_hash")))
    sent = docs.join(routes, docs["_id"].eqNullSafe(routes["doc_id"]) & (docs["_hash"] == routes["text_hash"]))
    sent = sent.select("a", "part", "role", "class", "_text").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_set = None, None
        for batch in (part for whole in batches for part in slices(whole)):
            out = []
            for a, role, one, text in zip(batch.column("a").to_pylist(), batch.column("role").to_pylist(), batch.column("class").to_pylist(), texts_of(batch, "_text")):
                if role == 0:
                    if a != head:
                        head, head_set = a, shingle_set(text)
                elif similar(head_set, shingle_set(text)):
                    out.append((a, one))
            yield pa.record_batch([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return stage(sent.mapInArrow(run, "a long, b long").distinct(), "links")


def within_radius(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    sigs = classes.select("class", "sig")
    both = pairs.join(sigs.withColumnsRenamed({"class": "a", "sig": "sig_a"}), "a").join(sigs.withColumnsRenamed({"class": "b", "sig": "sig_b"}), "b")
    return both.where(near("sig_a", "sig_b")).select("a", "b")


def with_signatures(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with the signature of their class, which is joined once a class, in however many buckets (at most as many as keys) it is."""
    of_class = F.collect_list(F.struct(*[c for c in rows.columns if c != "class"])).alias("_rows")
    found = rows.groupBy("class").agg(of_class).join(classes.select("class", "sig"), "class")
    return found.select("class", "sig", F.explode("_rows").alias("_row")).select("class", "_row.*", "sig")


def cross_pairs(members: DataFrame, components: DataFrame, classes: DataFrame, nearest: bool) -> DataFrame:
    """Pairs within the radii that share a bucket but no component, without those that have the bucket's least class;
    or for every class that is not of the least class's component only the ``nearest`` one.

    The members of the least class's own component (the heads) are paired with the others only, and the others among themselves; up to
    BLOCK of both in one cell.
    """
    labelled = members.join(components, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    labelled = stage(labelled, "labelled")
    heads = labelled.where("class = center").select("key", F.col("comp").alias("head_comp"))
    marked = labelled.join(heads, "key").withColumn("other", F.col("comp") != F.col("head_comp"))
    counts = marked.groupBy("key").agg(F.sum(F.when(F.col("other"), 1).otherwise(0)).alias("n_other"), F.sum(F.when(~F.col("other") & (F.col("class") != F.col("center")), 1).otherwise(0)).alias("n_head"))
    counts = stage(counts.where("n_other > 1 OR (n_other = 1 AND n_head > 0)"), "mixed")
    rows = with_signatures(marked.where("class <> center").join(counts, "key").select("key", "class", "comp", "other", "n_other", "n_head"), classes)
    blocks = lambda n: F.greatest(F.ceil(F.col(n) / BLOCK), F.lit(1)).cast("int")
    rows = rows.withColumns({"ho": blocks("n_head"), "oo": blocks("n_other")})
    own = F.pmod(F.xxhash64("class", "key"), F.when(F.col("other"), F.col("oo")).otherwise(F.col("ho"))).cast("int")
    rows = rows.withColumn("own", own)
    up_to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    mixed = F.when(F.col("n_head") == 0, F.array().cast("array<struct<kind:int,i:int,j:int>>")).when(F.col("other"), F.transform(up_to("ho"), lambda h: cell(0, h, F.col("own")))).otherwise(F.transform(up_to("oo"), lambda o: cell(0, F.col("own"), o)))
    among = F.when(F.col("other"), F.transform(up_to("oo"), lambda o: cell(1, F.least(o, F.col("own")), F.greatest(o, F.col("own"))))).otherwise(F.array().cast("array<struct<kind:int,i:int,j:int>>"))
    cells = F.when(F.col("n_head") + F.col("n_other") <= BLOCK, F.array(cell(2, F.lit(0), F.lit(0)))).otherwise(F.concat(mixed, among))
    dealt = rows.select("key", "class", "comp", "other", "own", "sig", F.explode(cells).alias("cell")).select("key", "cell.*", "class", "comp", "other", "own", "sig")
    dealt = dealt.repartition("key", "kind", "i", "j").sortWithinPartitions("key", "kind", "i", "j")

    def compare(rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        kind, i, j = rows[0][1:4]
        sigs, wides, odds = sig_parts([r[8] for r in rows])
        ids, comps, others, owns = (np.array([r[k] for r in rows]) for k in (4, 5, 6, 7))
        keys = None if nearest else chunk_keys(sigs)
        for x in np.flatnonzero(others):
            wanted = comps != comps[x]
            if kind == 0:  # others against heads
                wanted &= ~others
            elif i != j:  # pairs of one block meet in their own cell
                wanted &= owns != owns[x]
            if kind != 0 and not nearest:
                wanted[: x + 1] &= ~others[: x + 1]  # either order is the same pair
            at = np.flatnonzero(wanted)
            if len(at):
                d = distances(sigs[at], wides[at], odds[at], sigs[x : x + 1], wides[x : x + 1], odds[x : x + 1])
                close = np.array([np.argmin(d)]) if nearest else np.flatnonzero(d <= WIDE_RADIUS)
                if not nearest and len(close):  # a pair meets in all keys that it shares
                    shared = np.where(keys[at[close]] == keys[x], keys[x], np.iinfo(np.int64).max)
                    close = close[shared.min(axis=1) == rows[0][0]]
                for y in close.tolist():
                    if d[y] <= WIDE_RADIUS:
                        yield int(ids[x]), int(ids[at[y]]), int(d[y])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for row in zip(*(batch.column(n).to_pylist() for n in ("key", "kind", "i", "j", "class", "comp", "other", "own", "sig"))):
                if held and held[0][:4] != row[:4]:
                    out += compare(held)
                    held = []
                held.append(row)
            yield _pairs(out)
        if held:
            yield _pairs(list(compare(held)))

    found = dealt.mapInArrow(run, "x long, y long, d int")
    if nearest:
        found = found.groupBy("x").agg(F.min(F.struct("d", "y")).alias("m")).select("x", "m.y")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _pairs(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    rows = list(dict.fromkeys(rows))
    return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], names=["x", "y", "d"])


def rooted(edges: DataFrame) -> DataFrame:
    """class and comp of every end of the edges (a, b): each class points to its least neighbour, or to itself if that is greater, and the
    pointers are followed to the roots of the trees that they form. Each step halves the depth and is stored."""
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("class", "to")
    trees = stage(both.groupBy("class").agg(F.min("to").alias("to")).select("class", F.least("class", "to").alias("comp")), "trees")
    for _ in range(MAX_ROUNDS):
        above = trees.select(F.col("class").alias("comp"), F.col("comp").alias("next"))
        jumped = stage(trees.select("class", "comp").join(above, "comp").select("class", F.col("comp").alias("old"), F.col("next").alias("comp")), "trees")
        trees = jumped.select("class", "comp")
        if jumped.where("old <> comp").isEmpty():
            return trees
    raise RuntimeError(f"trees were not followed to their roots in {MAX_ROUNDS} rounds")


def between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links (a, b) that join different components, as pairs of the components, each once. A class without a label is one of its own."""
    ends = links.join(labels.toDF("a", "comp_a"), "a", "left").join(labels.toDF("b", "comp_b"), "b", "left")
    ends = ends.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b")).where("a <> b")
    return ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def relabelled(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """The stored labels after their components were joined as ``joined`` (class, comp) says, with the classes that only it has."""
    moved = labels.join(joined.toDF("comp", "next"), "comp", "left").select("class", F.coalesce("next", "comp").alias("comp"))
    return stage(moved.union(joined.join(labels, "class", "left_anti").select("class", "comp")), "labels")


def connected(links: DataFrame) -> DataFrame:
    """class and comp (the least class reachable) of every class with a link.

    Round after round the trees of ``rooted`` are drawn together into their roots, so a link is read again only while its ends are
    apart. A class that no neighbour points to has a lesser one in the next round, so two rounds at least halve the classes left."""
    edges = stage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    for _ in range(MAX_ROUNDS):
        trees = rooted(edges)
        labels = trees if labels is None else relabelled(labels, trees)
        edges = stage(between(edges, trees), "edges")
        if edges.isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def grouped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id, comp (a number of the component) and component_id (its least id) of every row; the last
    two are null for empty sets."""
    rows = signatures(df, id_col, text_col)
    # A class is named by the number of one of its rows, whose text stands for it.
    one = F.min_by(F.struct("row", "doc_id", "text_hash", "sig"), "row")
    classes = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("least"), one.alias("one"))
    classes = stage(classes.select("set_id", "least", F.col("one.row").alias("class"), "one.doc_id", "one.text_hash", "one.sig"), "classes")

    keys = key_rows(classes)  # cheaper to make twice than to store
    buckets = keys.groupBy("key").agg(F.min("class").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(keys.join(stage(buckets.select("key", "center"), "buckets"), "key"), "members")
    stars = members.where("class <> center").select(F.col("center").alias("a"), F.col("class").alias("b")).distinct()
    stars = stage(within_radius(stars, classes), "stars")
    links, tested = confirm(stars, classes, df, id_col, text_col), stars
    labels, joins, last = connected(links), True, False
    for part in range(NEAREST + 1):
        last = not joins or part == NEAREST
        some = members if last else members.where(F.pmod("key", F.lit(PARTS)) == part % PARTS)
        more = stage(cross_pairs(some, labels, classes, nearest=not last).join(tested, ["a", "b"], "left_anti"), "cross")
        found = None if more.isEmpty() else confirm(more, classes, df, id_col, text_col)
        joins = found is not None and not found.isEmpty()
        if joins:  # only the components that the new links join are connected anew
            labels = relabelled(labels, connected(between(found, labels)))
        if last:
            break
        tested = tested.union(more)
    named = classes.join(labels, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_set = stage(named.join(least, "comp").select("set_id", "comp", "component_id"), "components")
    return rows.select("doc_id", "text_hash", "n_shingles", "set_id").join(of_set, "set_id", "left")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept of every row."""
    with small_batches(df.sparkSession):
        out = grouped(df, id_col, text_col)
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with its columns: exactly one of each component, of those with its least id the one with the
    least text hash, and one of equal rows (id and text) without words."""
    d, t, n = unused(df, "_d", "_t", "_n")
    with small_batches(df.sparkSession):
        found = grouped(df, id_col, text_col)
    alike = found.groupBy("comp", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")).alias("one")
    linked = alike.where("comp IS NOT NULL").groupBy("comp").agg(one).select("one.doc_id", "one.text_hash", "one.n")
    chosen = stage(linked.union(alike.where("comp IS NULL").select("doc_id", "text_hash", "n")).toDF(d, t, n), "chosen")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(d)) & F.xxhash64(F.col(text_col).cast("string")).eqNullSafe(F.col(t))
    single = df.join(chosen.where(F.col(n) == 1), same, "left_semi")
    # Only rows that occur more than once are shuffled to take one of them.
    repeated = df.join(chosen.where(F.col(n) > 1), same).dropDuplicates([d, t])
    return single.union(repeated.select(*quoted(df)))
