import random
from collections import Counter

import pytest

from ebbline.llm import quality as q
from ebbline.llm.queries import ORACLES, QUERIES
from tests.compare import oracle_connection, oracle_rows, schema_differences, spark_rows


def brute_repeats(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(covered)


def test_repeated_words_against_brute_force():
    random.seed(3)
    for _ in range(300):
        words = random.choices([b"a", b"b", b"c"], k=random.randint(0, 60)) + random.choices([b"a", b"d", b"e", b"f", b"g", b"h"], k=20)
        assert q.repeated_words(words) == brute_repeats(words)
    assert q.repeated_words([b"x"] * 9) == 9 and q.repeated_words([b"x"] * 8) == 0


def test_measurements(spark, documents):
    text = "Ab\xa0c é#|\nsame line\n \nsame line\n\tx\x0by"
    row = q.measure(text.encode())
    assert row == (8, sum(map(len, text.replace("\n", " ").replace("\t", " ").replace("\x0b", " ").split(" "))), 2, 4, 1, 0)
    rows = [(1, None), (2, ""), (None, "word " * 30), (3, "one two three four five six seven eight nine ten " * 3), (3, "z" * 100_000)]
    got = {(r.doc_id, r.n_words): r for r in q.ledger(documents(rows).withColumnRenamed("lang", "n_words")).collect()}
    assert got[(1, 0)].fail_bits == q.bits("too_few_words") == got[(2, 0)].fail_bits
    assert got[(None, 30)].n_repeat_words == 30
    assert got[(3, 1)].fail_bits == q.bits("too_few_words", "mean_word_long")
    assert q.ledger(documents([])).collect() == []


def test_policies_and_ablations(spark):
    few, rep, sym, some = (q.bits(n) for n in ("too_few_words", "repeated_windows", "symbol_words", "some_repeats"))
    ledger = spark.createDataFrame([(i, b) for i, b in enumerate([0, few, few | sym, sym, rep | some, some, 0])], "doc_id long, fail_bits long")
    kept = {p.version: {r.doc_id for r in q.apply_policy(ledger, p).where("kept").collect()} for p in q.POLICIES}
    assert kept == {"base": {0, 3, 5, 6}, "v1": {0, 5, 6}, "v2": {0, 6}}
    sole = {r.doc_id: r.sole_rule for r in q.apply_policy(ledger, q.V1).collect()}
    assert sole == {0: None, 1: "too_few_words", 2: None, 3: "symbol_words", 4: "repeated_windows", 5: None, 6: None}
    report = {(r.policy, r.rule): (r.documents, r.rejected, r.failing, r.kept_without) for r in q.ablations(ledger).collect()}
    assert report["v1", "symbol_words"] == (7, 4, 2, 1)
    assert report["v2", "some_repeats"] == (7, 5, 2, 1)
    assert len(report) == sum(p.mask.bit_count() for p in q.POLICIES)


@pytest.mark.parametrize("name", ["op3_quality_rules", "quality_ablations"])
def test_query_matches_sql(spark, sf_dir, name):
    con = oracle_connection(sf_dir)
    df = QUERIES[name](spark, sf_dir)
    sql = ORACLES[name]
    assert schema_differences(df, con, sql) == []
    assert spark_rows(df) == oracle_rows(con, sql)
