import math

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from compare import oracle_connection, oracle_rows, schema_differences, spark_rows
from ebbline.llm import hard_negatives as hn
from ebbline.llm import queries

SCHEMA = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())), StructField("label", IntegerType()), StructField("score", StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)


def brute(rows, every, positives=5, negatives=10):
    """Every anchor against every row; rows are told apart by their place in the list."""
    kept = []
    for i, x, label in rows:
        if label is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, [math.floor(256 * c) for c in x], label))
    out = []
    for n, (a_id, a, a_label) in enumerate(kept):
        if a_id is None or a_id % every:
            continue
        scored = [(-sum(p * q for p, q in zip(a, x)), (i is None, i or 0), label) for m, (i, x, label) in enumerate(kept) if m != n]
        scored.sort(key=lambda s: s[:2])
        for p in [s for s in scored if s[2] == a_label][:positives]:
            ps = -p[0]
            inside = [s for s in scored if s[2] != a_label and 30 * ps <= -100 * s[0] <= 90 * ps][:negatives]
            out += [(a_id, None if p[1][0] else p[1][1], r, None if s[1][0] else s[1][1], ps, -s[0]) for r, s in enumerate(inside, 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 7)
    monkeypatch.setattr(hn, "CANDIDATES", 16)
    monkeypatch.setattr(hn, "STRIPE_ROWS", 40)


def clustered(seed, n, size=6, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, size))
    vectors = centres[rng.integers(0, 4, n)] + rng.normal(size=(n, size)) * 0.1
    return [(int(i), [float(x) for x in v], int(rng.integers(0, labels))) for i, v in zip(rng.permutation(n), vectors)]


def test_rows_equal_brute_force(spark, small):
    rows = clustered(1, 300)
    rows += [(400 + k, rows[0][1], k % 3) for k in range(60)]  # many copies of one vector: all scores tie
    assert found(hn.hard_negatives(frame(spark, rows), every=10)) == brute(rows, 10)


def test_odd_rows(spark, small):
    rows = clustered(2, 120)
    rows += [(500, None, 1), (510, [1.0, None], 1), (520, [math.nan, 1.0], 0), (530, [math.inf], 2), (540, [], 1), (550, [0.5, 0.25], None), (560, [0.5], 2), (None, rows[3][1], 1), (None, rows[4][1], 0), (570, [-1.0] * 6, 0), (580, [0.0] * 9, 1), (590, [2.0] * 9, 2)]
    assert found(hn.hard_negatives(frame(spark, rows), every=10)) == brute(rows, 10)
    assert found(hn.hard_negatives(frame(spark, rows[:1]), every=1)) == []
    assert found(hn.hard_negatives(frame(spark, []))) == []


def test_repeated_rows(spark, small):
    rows = clustered(3, 60)
    rows += rows[:25]
    got, want = found(hn.hard_negatives(frame(spark, rows), every=10)), brute(rows, 10)
    assert got == want


def test_large_numbers_stay_exact(spark, small):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(0, 1 << 22, 5)], i % 2) for i in range(60)]
    assert found(hn.hard_negatives(frame(spark, rows), every=5)) == brute(rows, 5)


def test_tree_spans_and_bounds_hold():
    rng = np.random.default_rng(7)
    anchors = np.floor(rng.normal(size=(40, 8)) * 50)
    block = hn.Block([(i, 0, v.tobytes()) for i, v in enumerate(anchors)])
    assert sorted(block.below()) == list(range(40)) and (block.parent[1:] >= 0).all()
    vectors = np.floor(rng.normal(size=(100, 8)) * 50)
    norms = np.sqrt((vectors**2).sum(axis=1))
    asked = []

    def wanted(x, low, high):
        exact = vectors @ anchors[x]
        assert (low <= exact).all() and (exact <= high).all()
        asked.append(x)
        return rng.random(100) < 0.3  # the bounds hold whatever was scored above

    for x, at, exact in block.walk(vectors, norms, wanted):
        assert (exact == (vectors @ anchors[x])[at]).all()
    assert len(asked) == 39


def test_few_candidates_are_scored_anew_near_a_parent():
    rng = np.random.default_rng(8)
    anchors = 1000 + np.floor(rng.normal(size=(30, 8)))  # close together
    block = hn.Block([(i, 0, v.tobytes()) for i, v in enumerate(anchors)])
    vectors = np.floor(rng.normal(size=(500, 8)) * 1000)
    norms = np.sqrt((vectors**2).sum(axis=1))
    scored = sum(len(at) for x, at, _ in block.walk(vectors, norms, lambda x, low, high: high >= 2_500_000) if block.parent[x] >= 0)
    assert scored < 0.5 * 29 * 500


def test_query_equals_sql(spark, sf_dir):
    df, sql = queries.QUERIES["op13_hard_negatives"](spark, sf_dir), queries.ORACLES["op13_hard_negatives"]
    con = oracle_connection(sf_dir)
    assert not schema_differences(df, con, sql)
    assert spark_rows(df) == oracle_rows(con, sql)
    assert df.count() > 20
