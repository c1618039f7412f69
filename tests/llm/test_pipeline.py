import corpus_pipeline as cp
from ebbline.llm import mixing, toxicity
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_near_duplicates import brute as brute_groups
from tests.llm.test_token_files import expected

import __spark_entry__


def test_every_stage_on_what_the_one_before_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns, stages = docs.columns, dict(cp.STAGES)
    rows = lambda df: sorted((r.doc_id, r.text) for r in df.collect())

    one = cp.stage(stages["toxicity"](spark, docs, sf_dir), "test")
    rejected = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    assert rows(one) == [r for r in rows(docs) if r[0] not in rejected]

    two = cp.stage(stages["near_duplicates"](spark, one, sf_dir), "test")
    keep = {r[0] for r in brute_groups(rows(one)) if r[3]}
    assert rows(two) == [r for r in rows(one) if r[0] in keep]

    three = cp.stage(stages["decontamination"](spark, two, sf_dir), "test")
    hit = {r[0] for r in brute_hits(rows(two), items) if r[5]}
    assert rows(three) == [r for r in rows(two) if r[0] not in hit]

    four = cp.stage(stages["mixing"](spark, three, sf_dir), "test")
    copies = {r.doc_id: r.copies for r in mixing.mix_plan(three).collect()}
    assert rows(four) == sorted(r for r in rows(three) for _ in range(copies[r[0]]))

    five = stages["token_files"](spark, four, sf_dir)
    want = expected(rows(four))
    assert sorted(tuple(r) for r in five.collect()) == want
    for df in (one, two, three, four):
        assert df.columns == columns
    assert sorted(tuple(r) for r in cp.run(spark, sf_dir).collect()) == want


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_files"]
