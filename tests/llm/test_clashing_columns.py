"""Stages on tables whose further columns are called as the operators' own, or hold signs that names are parsed by."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from ebbline.llm import decontamination, mixing, near_duplicates, privacy, toxicity

NAMES = ["_d", "_t", "_n", "__d", "_spans", "_id", "_text", "_hash", "_row", "_class", "_k", "_mix_row", "_mix_id", "_mix_hash", "_mix_copies", "_mix_copy", "row", "class", "comp", "text_hash", "toxic", "a.b", "a`b"]


def words(seed, n=30):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abdegilmnorst", k=6)) for _ in range(n))


@pytest.fixture
def tables(spark, documents):
    rows = [(i, words(i) + (" blimpfoo zugzwax" if i % 4 == 0 else ""), "ab"[i % 2]) for i in range(80)]
    rows += [(100, rows[1][1]), (101, words(7, 12) + " " + words(999, 12)), (102, None), (1, rows[1][1], "b"), (103, "mail zara@mail.example.com")]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(7, words(999, 12))], "item_id long, text string")
    return documents(rows), labels, items


def wide(df):
    return df.select("*", *(F.lit(i).alias(name) for i, name in enumerate(NAMES)))


def test_stages_keep_the_same_rows(tables):
    docs, labels, items = tables
    runs = {
        "toxicity": lambda d: toxicity.clean_rows(d, labels),
        "near": near_duplicates.kept_rows,
        "decontamination": lambda d: decontamination.clean_rows(d, items),
        "sanitise": privacy.sanitise,
    }
    for name, run in runs.items():
        plain, other = run(docs), run(wide(docs))
        assert other.columns == wide(docs).columns, name
        got = sorted((r.doc_id, str(r.text), r.source) for r in other.collect())
        assert got == sorted((r.doc_id, str(r.text), r.source) for r in plain.collect()), name
        assert 0 < len(got) and (name == "sanitise" or len(got) < docs.count()), name


def test_mix_takes_every_row_as_planned(tables):
    docs = wide(tables[0])
    planned = {}
    for r in mixing.mix_plan(docs).collect():
        planned[r.doc_id] = planned.get(r.doc_id, 0) + r.copies
    mixed = mixing.mix(docs)
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == docs.columns and got == {i: n for i, n in planned.items() if n}


def test_pipeline(spark, tables, save):
    docs, labels, items = tables
    folder = save(documents=wide(docs), labels=labels, benchmark=items)
    got = cp.run(spark, folder).collect()
    plain = dict(cp.STAGES)
    kept = docs
    for name in ("toxicity", "near_duplicates", "decontamination"):
        kept = cp.stage(plain[name](spark, kept, folder), "test")
    assert got and {r.doc_id for r in got} <= {r.doc_id for r in kept.collect()}
