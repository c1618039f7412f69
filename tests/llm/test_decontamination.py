import hashlib
import random
import re
from collections import Counter

import __spark_entry__
from ebbline.llm import decontamination as dc
from ebbline.llm.queries import ORACLES, op5_benchmark_decontamination
from tests.compare import oracle_connection, oracle_rows, schema_differences, spark_rows


def tokens(text):
    return [w for w in re.split(dc.SEPARATORS, (text or "").translate(str.maketrans(dc.UPPER, dc.LOWER))) if w]


def brute(rows, items):
    out = []
    for doc_id, text in rows:
        words, hit, found = tokens(text), set(), set()
        for item_id, item in items:
            own = tokens(item)
            size = min(10, len(own))
            windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
            for i in range(len(words) - size + 1) if own else ():
                if tuple(words[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(item_id)
        digest = hashlib.sha256(",".join(sorted(str(i) for i in found if i is not None)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=lambda r: (r[0] is None, r))


def tables(spark, rows, items):
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def corpus():
    rng = random.Random(2)
    common = ["the", "of", "and", "Is", "über"]
    item = lambda n: " ".join(rng.choice(common + [f"w{rng.randrange(40)}"]) for _ in range(n))
    items = [(i, item(rng.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(30)] + [(50, None), (51, ""), (3, "another text, with one id: three!"), (60, "the the the the the the the the the the the the"), (61, "...")]
    items += [items[4], (70, "Zürich 99 漢字 x")]
    rows = []
    for i in range(60):
        parts = [item(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 3)):
            text = rng.choice(items)[1] or ""
            cut = text.split(" ")
            a = rng.randrange(0, max(1, len(cut) - 9))
            parts += [" ".join(cut[a : a + rng.choice([8, 10, 12, 99])]).upper(), item(rng.randrange(0, 5))]
        rows.append((i, ", ".join(parts)))
    rows += [(100, None), (101, ""), (None, "the " * 200), (102, "zürich-99 漢字\nX"), (0, rows[0][1]), (0, "other text of the same id " + (items[6][1] or "")), (103, "the " * 30_000)]
    return rows, items


def collected(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=lambda r: (r[0] is None, r))


def test_operator_equals_brute_force(spark):
    rows, items = corpus()
    docs, bench = tables(spark, rows, items)
    got = dc.decontaminate(docs.withColumn("n_words", docs.text).withColumn("item_id", docs.doc_id), bench.withColumn("term", bench.text))
    assert collected(got) == brute(rows, items)


def test_query_matches_sql(spark, sf_dir):
    con = oracle_connection(sf_dir)
    df = op5_benchmark_decontamination(spark, sf_dir)
    assert schema_differences(df, con, ORACLES["op5_benchmark_decontamination"]) == []
    assert spark_rows(df) == oracle_rows(con, ORACLES["op5_benchmark_decontamination"])


def test_plan_of_the_index_has_no_python_and_no_shuffle(spark, sf_dir, capsys):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    terms = dc.number_terms(dc.item_texts(spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(dc.F.explode("w").alias("term")))
    tokens = docs.select("doc_id", dc.F.explode(dc.words(dc.F.col("text"))).alias("term")).join(terms, "term")
    tokens.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "hashpartitioning" not in plan


def test_empty_tables(spark):
    rows, items = corpus()
    docs, bench = tables(spark, rows, items)
    none_docs, none_items = tables(spark, [], [])
    assert dc.decontaminate(none_docs, bench).count() == 0
    assert collected(dc.decontaminate(docs, none_items)) == brute(rows, [])


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    near = "so alpha beta then gamma delta and epsilon zeta eta x theta iota kappa lambda mu"
    apart = " filler ".join(item.split()[:3]) + " filler" * 40 + " kappa"
    docs, bench = tables(spark, [(1, near), (2, apart), (3, item), (4, "nothing")], [(1, item)])
    got = {r.doc_id: (r.contaminated, r.n_near_items) for r in dc.decontaminate(docs, bench).collect()}
    assert got == {1: (False, 1), 2: (False, 0), 3: (True, 1), 4: (False, 0)}


def test_registered_query_returns_proximity_matches(spark, save, documents):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    near = "so alpha beta then gamma delta and epsilon zeta eta x theta iota kappa lambda mu"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    sf_dir = save(documents=documents([(1, near), (2, item), (3, "nothing")]), benchmark=items)
    got = __spark_entry__.queries()["benchmark_proximity"](spark, sf_dir)
    assert {r.doc_id: (r.contaminated, r.n_near_items) for r in got.collect()} == {1: (False, 1), 2: (True, 1), 3: (False, 0)}


def brute_near(rows, items):
    """Items with a proximity match per document, by the definition."""
    split = tokens
    texts = {i: split(t) for i, t in items}
    vocabulary = {w for t in texts.values() for w in t}
    df = Counter(w for _, t in rows for w in split(t) if w in vocabulary)
    out = {}
    for doc_id, text in rows:
        out[doc_id] = 0
        for w in texts.values():
            seeds = set()
            for start in range(max(len(w) - dc.WINDOW, 0) + 1):
                seeds |= set(sorted(range(start, min(start + dc.WINDOW, len(w))), key=lambda i: (df[w[i]], i))[: dc.SEEDS])
            spots = [(p - i, i) for p, x in enumerate(split(text), 1) for i in seeds if w[i] == x]
            best = max((len({i for e, i in spots if d <= e <= d + dc.SLOP}) for d, _ in spots), default=0)
            out[doc_id] += bool(w) and best >= min(dc.NEAR_SEEDS, len(seeds))
    return out


def test_proximity_equals_the_definition(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 10, 14, 30])))) for i in range(12)] + [(50, ""), (51, "w1 " * 14)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 150)))) for i in range(40)] + [(90, None), (91, "w1 " * 60)]
    for n, (_, text) in enumerate(items[:12]):
        words = text.split()
        for k in range(4):  # words put in and left out
            changed = [x for w in words for x in ([w, "new"] if rng.random() < 0.25 else [] if rng.random() < 0.15 else [w])]
            rows.append((100 + 10 * n + k, " ".join(rng.choices(vocabulary, k=k * 7) + changed)))
    docs, bench = tables(spark, rows, items)
    got = {r.doc_id: r.n_near_items for r in dc.decontaminate(docs, bench).collect()}
    want = brute_near(rows, items)
    assert got == want and len(set(want.values())) > 2
