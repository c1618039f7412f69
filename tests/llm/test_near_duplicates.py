import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbline.llm import common, near_duplicates as nd
from ebbline.llm.queries import op4_near_duplicates


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """doc_id, n_shingles, component_id, kept from all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(d, len(s), least.get(root(i)), d == least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def run(df):
    return ordered((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(df).collect())


def edited(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.randrange(10**9)}"
    return words


def corpus():
    rng = random.Random(11)
    rows = []
    for g in range(6):  # groups of near copies, and chains of ever farther ones
        base = [f"g{g}w{i}" for i in range(120)]
        for _ in range(8):
            rows.append(" ".join(edited(base, rng.randint(0, 4), rng)))
        chain = base
        for _ in range(8):
            chain = edited(chain, 2, rng)
            rows.append(" ".join(chain))
    passage = [f"shared{i}" for i in range(60)]  # unlike texts with a common passage
    for i in range(40):
        rows.append(" ".join([f"x{i}y{j}" for j in range(rng.choice([5, 20, 60]))] + passage))
    rows += ["a b c", "A  b\tc", "a b", "", "same five words are here", "same five words are here", "z" * 50_000, "q " * 20_000]
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)] + [(1, rows[0]), (None, rows[5]), (None, "alone and without any id"), (9001, None)]


@pytest.mark.parametrize("sizes", [(512, 200), (4, 3)])
def test_components_equal_brute_force(spark, documents, monkeypatch, sizes):
    monkeypatch.setattr(nd, "BLOCK", sizes[0])
    monkeypatch.setattr(nd, "LINKS", sizes[1])
    rows = corpus()
    assert run(documents(rows).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "class")) == ordered(brute(rows))


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = ordered((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op4_near_duplicates(spark, sf_dir).collect())
    assert got == ordered(brute(rows))


def test_every_pair_within_the_radius_shares_a_key():
    rng = np.random.default_rng(1)
    for errors in (nd.RADIUS, nd.RADIUS - 5, 3):
        for _ in range(100):
            a = rng.integers(0, 1 << 16, nd.SYMBOLS, dtype=np.uint16)
            b = a.copy()
            at = rng.permutation(nd.SYMBOLS)[:errors]
            b[at] += 1
            keys = nd.chunk_keys(np.stack([a, b]))
            assert set(keys[0]) & set(keys[1])


def test_signature_distance_estimates_similarity():
    shared, own = [f"w{i}" for i in range(4000)], [f"v{i}" for i in range(1000)]
    a = nd.shingle_set(" ".join(shared).encode())
    b = nd.shingle_set(" ".join(shared + own).encode())
    sims = np.mean(nd.signature(a) == nd.signature(b))
    assert abs(sims - 0.8) < 0.2 and nd.similar(a, b)


def test_radii_keep_pairs_above_the_threshold():
    rng = np.random.default_rng(3)
    for _ in range(300):  # similarity 0.75 to 0.77
        both, own = rng.integers(0, 1 << 63, 600, dtype=np.uint64), rng.integers(0, 1 << 63, 190, dtype=np.uint64)
        a, b = np.unique(np.concatenate([both, own[:95]])), np.unique(np.concatenate([both, own[95:]]))
        if nd.similar(a, b):
            assert nd.distances(*nd.sig_parts([nd.full_signature(a)]), *nd.sig_parts([nd.full_signature(b)]))[0] <= nd.WIDE_RADIUS


def test_empty_table_and_no_links(spark, documents):
    assert run(documents([])) == []
    assert run(documents([(2, "one text"), (1, "another one")])) == [(1, 1, 1, True), (2, 1, 2, True)]


def test_chain_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    assert {r["class"]: r.comp for r in nd.connected(chain).collect()} == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_one_row_of_each_component_stays(spark, documents):
    base = [f"word{i}" for i in range(60)]
    near = lambda k: " ".join(base + [f"end{k}"])
    rows = [(1, near(1))] * 3 + [(1, near(2)), (2, near(3))]  # repeated rows, and two texts of the least id
    rows += [(None, "other " + " ".join(reversed(base))), (None, "others " + " ".join(reversed(base)))] * 2  # near copies without ids
    rows += [(7, "a text that stands alone here"), (8, ""), (8, ""), (8, None), (9, "")]
    df = documents(rows)
    kept = nd.kept_rows(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sum(bool(t) and t.startswith("word0") for _, t in got) == 1 and [i for i, t in got if t and t.startswith("word0")] == [1]
    assert sum(bool(t) and t.startswith("other") for _, t in got) == 1
    assert sorted((r for r in got if not r[1] or r[0] == 7), key=str) == sorted([(7, "a text that stands alone here"), (8, ""), (8, None), (9, "")], key=str)
    assert len(got) == 6


def test_a_long_chain_of_near_copies(spark, documents, monkeypatch):
    """Each text differs from the one before in a few words, so only neighbours are linked; and a second group of texts whose pairs lie
    just below the similarity, all within the radii."""
    monkeypatch.setattr(nd, "BLOCK", 64)
    proposed = []
    cross = nd.cross_pairs

    def counted(*args, **options):
        out = cross(*args, **options)
        proposed.append(out.count())
        return out

    monkeypatch.setattr(nd, "cross_pairs", counted)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(700):
        rows.append((10_000 - i, " ".join(words)))
        words[rng.randrange(100)] = f"n{i}"
    base = [f"b{i}" for i in range(100)]
    for i in range(60):
        own = list(base)
        for k in (10, 50, 90):
            own[k] = f"o{i}-{k}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(documents(rows)).collect()}
    texts = dict(rows)
    sets = {i: nd.shingle_set(t.encode()) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i] = parent[parent[i]]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (a < 1000) == (b < 1000) and root(a) != root(b) and nd.similar(sets[a], sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {i: root(i) for i in ids}
    assert max(proposed) < 12 * len(rows)  # of about 20,000 pairs of the chain within the radii


def test_signatures_are_joined_once_a_class(spark):
    rows = spark.createDataFrame([(k, c, 10 * c) for c in range(5) for k in range(20)], "key long, class long, comp long")
    classes = spark.createDataFrame([(c, bytes([c])) for c in range(7)], "class long, sig binary")
    found = nd.with_signatures(rows, classes)
    assert sorted((r.key, r["class"], r.comp, bytes(r.sig)) for r in found.collect()) == sorted((k, c, 10 * c, bytes([c])) for c in range(5) for k in range(20))
    joined = found._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")
    assert "Generate explode" in joined[0] and "Aggregate [class" in joined[1]


def test_components_of_any_graph(spark):
    rng = random.Random(4)
    pairs = [(999, i) for i in range(40)] + [(i, i - 1) for i in range(1100, 1040, -1)]  # a star with the greatest number in its middle, a chain
    for i in range(30):  # chains whose least numbers lie apart
        pairs += [(2000 + i, 3000 + i), (3000 + i, 2001 + i)]
    pairs += [(rng.randrange(4000, 4400), rng.randrange(4000, 4400)) for _ in range(220)]
    pairs = [(a, b) for a, b in pairs if a != b]
    parent = {x: x for pair in pairs for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = nd.connected(spark.createDataFrame(pairs + pairs[:50], "a long, b long")).collect()
    assert sorted((r["class"], r.comp) for r in got) == sorted((x, root(x)) for x in parent)
    assert nd.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_are_read_while_their_ends_are_apart(spark, documents, monkeypatch):
    """A link inside a component is not read again, neither by later rounds of one call nor after more links are found."""
    stored, given, confirmed = [], [], []
    stage, connected, confirm = nd.stage, nd.connected, nd.confirm

    def staged(df, label):
        out = stage(df, label)
        stored.extend([out.count()] if label == "edges" else [])
        return out

    def watched(function, counts, of_result):
        def call(*args):
            out = function(*args)
            counts.append((out if of_result else args[0]).count())
            return out

        return call

    monkeypatch.setattr(nd, "stage", staged)
    nd.connected(spark.range(1, 301).selectExpr("0L AS a", "id AS b"))
    assert stored == [300, 0]
    monkeypatch.setattr(nd, "connected", watched(connected, given, False))
    monkeypatch.setattr(nd, "confirm", watched(confirm, confirmed, True))
    rng = random.Random(5)
    words, rows = [f"w{i}" for i in range(100)], []
    for i in range(200):
        rows.append((1_000 - i, " ".join(words)))
        for k in rng.sample(range(100), 2):
            words[k] = f"n{i}-{k}"
    rng.shuffle(rows)
    assert {r.component_id for r in nd.near_duplicates(documents(rows)).collect()} == {min(i for i, _ in rows)}
    assert len(given) > 1 and sum(given) <= sum(confirmed)


def test_parities_rule_out_only_unlike_sets():
    rng = np.random.default_rng(7)
    unlike, ruled_out = 0, 0
    for n in (1, 2, 5, 30, 150, 400, 3000):
        for own in (0, 1, n // 12, n // 8, n // 7, n // 6, n // 5, n // 3):
            for _ in range(20):
                both, left, right = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in (n, own, rng.integers(0, own + 1)))
                a, b = np.unique(np.concatenate([both, left])), np.unique(np.concatenate([both, right]))
                odds = [nd.sig_parts([nd.full_signature(x)])[2] for x in (a, b)]
                assert nd.may_be_similar(*odds)[0] or not nd.similar(a, b)
                unlike += n in (30, 150) and not nd.similar(a, b)
                ruled_out += n in (30, 150) and not nd.may_be_similar(*odds)[0]
    assert unlike > 20 and ruled_out > 0.7 * unlike


def test_texts_just_below_the_similarity_are_not_paired(spark, documents, monkeypatch):
    """A large group of texts that are all nearly linked does not send all its pairs to be confirmed on the texts."""
    proposed = []
    confirm = nd.confirm
    monkeypatch.setattr(nd, "confirm", lambda pairs, *args: proposed.append(pairs.count()) or confirm(pairs, *args))
    rows = []
    for i in range(60):
        words = [f"b{k}" for k in range(100)]
        for k in (10, 50, 90):
            words[k] = f"o{i}-{k}"
        rows.append((i, " ".join(words)))
    assert run(documents(rows)) == ordered(brute(rows)) == [(i, 96, i, True) for i in range(60)]
    assert sum(proposed) < 4 * len(rows)  # of 1,770 pairs


def test_what_goes_to_python_goes_in_small_batches(spark, documents, monkeypatch):
    """Executors and their workers keep what a batch once took; by default it holds 10,000 texts of any length."""
    name, seen, stage = "spark.sql.execution.arrow.maxBytesPerBatch", [], nd.stage
    before = spark.conf.get(name, None)
    monkeypatch.setattr(nd, "stage", lambda df, label: seen.append(spark.conf.get(name, None)) or stage(df, label))
    rows = [(i, " ".join(f"w{k}" for k in range(i % 3, 40))) for i in range(9)]
    assert run(documents(rows)) == ordered(brute(rows))
    assert len(seen) > 5 and set(seen) == {str(common.BATCH_BYTES)} and spark.conf.get(name, None) == before
    sizes = lambda batches: (pa.record_batch([pa.array([b.nbytes])], names=["n"]) for b in batches)
    texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 3000).alias("_text"))
    with common.small_batches(spark):
        got = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(got) > 4000 * 3000 and max(got) < 1.1 * common.BATCH_BYTES
    with pytest.raises(ValueError), common.small_batches(spark):
        raise ValueError
    assert spark.conf.get(name, None) == before
    spark.conf.set(name, "12345")  # one's own size stays
    with common.small_batches(spark):
        assert spark.conf.get(name) == "12345"
    assert spark.conf.get(name) == "12345"
    spark.conf.unset(name)
