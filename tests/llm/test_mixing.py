import random

import pytest

from ebbline.llm import mixing as mx
from ebbline.llm.queries import ORACLES, op8_mix_sources
from tests.compare import oracle_connection, oracle_rows, schema_differences, spark_rows


def filled(sizes):
    """Targets by sharing again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mx.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(1)
    for _ in range(6):
        sizes = {s: rng.choice([0, 1, 50, 1000, 40_000]) for s in ["a", "b", "é", "z", "A", None, "𝔘"][: rng.randint(1, 7)]}
        got = {r.source: r.target for r in mx.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        want = filled(sizes)
        assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def rows():
    rng = random.Random(9)
    out = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 20, 80])), rng.choice(["hot"] * 5 + ["b", "c", None])) for i in range(900)]
    return out + [(901, None, "b"), (902, "x " * 3000, "c"), (None, "a b c", "hot"), (5, "same", "b"), (5, "same", "b")]


def test_taken_words_come_near_the_targets(spark, documents):
    plan = mx.mix_plan(documents(rows())).collect()
    assert len(plan) == len(rows())
    per = {}
    for r in plan:
        one = per.setdefault(r.source, [r.target, 0, r.source_size, 0])
        one[1] += r.copies * r["size"]
        one[3] = max(one[3], r["size"])
        ratio = r.target / r.source_size
        assert int(ratio) <= r.copies <= -(-ratio // 1) <= 2
    assert {s: p[0] for s, p in per.items()} == pytest.approx(filled({s: p[2] for s, p in per.items()}))
    for target, taken, _, largest in per.values():
        assert abs(taken - target) <= largest + 0.02 * target


def test_reruns_agree_and_mix_repeats_rows(spark, documents):
    df = documents(rows()).withColumnRenamed("lang", "target").withColumnRenamed("n_chars", "_class")
    first = sorted((-1 if r.doc_id is None else r.doc_id, r.copies) for r in mx.mix_plan(df).collect())
    assert first == sorted((-1 if r.doc_id is None else r.doc_id, r.copies) for r in mx.mix_plan(df.repartition(5)).collect())
    mixed = mx.mix(df)
    assert mixed.columns == df.columns
    want = {}
    for i, n in first:
        want[i] = want.get(i, 0) + n
    got = {}
    for r in mixed.collect():
        got[r.doc_id if r.doc_id is not None else -1] = got.get(r.doc_id if r.doc_id is not None else -1, 0) + 1
    assert got == {i: n for i, n in want.items() if n}


def test_empty_and_zero_sizes(spark, documents):
    assert mx.mix_plan(documents([])).count() == 0 and mx.mix(documents([])).count() == 0
    got = mx.mix_plan(documents([(1, "", "a"), (2, None, None)])).collect()
    assert [(r.target, r.copies) for r in got] == [(0.0, 0), (0.0, 0)]


def test_query_matches_sql(spark, sf_dir):
    con, sql = oracle_connection(sf_dir), ORACLES["op8_mix_sources"]
    df = op8_mix_sources(spark, sf_dir)
    assert schema_differences(df, con, sql) == []
    assert spark_rows(df) == oracle_rows(con, sql)
