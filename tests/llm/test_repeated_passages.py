import random

import numpy as np
import pytest

from ebbline.llm import repeated_passages as rp
from ebbline.llm.queries import op9_repeated_passages


def brute(rows):
    """Merged spans of words inside a 50-word window that another document holds too."""
    docs = {}
    for doc_id, text in rows:
        docs[(doc_id, text)] = (text or "").encode().lower().split()
    holders = {}
    for key, words in docs.items():
        for i in range(len(words) - rp.MIN_WORDS + 1):
            holders.setdefault(tuple(words[i : i + rp.MIN_WORDS]), set()).add(key)
    out = set()
    for key, words in docs.items():
        spans = []
        for i in range(len(words) - rp.MIN_WORDS + 1):
            if len(holders[tuple(words[i : i + rp.MIN_WORDS])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + rp.MIN_WORDS
                else:
                    spans.append([i, i + rp.MIN_WORDS])
        out |= {(key[0], s, e) for s, e in spans}
    return out


def corpus():
    rng = random.Random(4)
    own = lambda tag, n: [f"{tag}{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for p, size in enumerate((49, 50, 51, 80, 200, 700)):
        passage = own(f"p{p}x", size)
        for k in range(3):
            rows.append(" ".join(own("a", rng.randrange(0, 90)) + passage + own("b", rng.randrange(0, 90))))
    common = own("hot", 60)
    rows += [" ".join(own("c", rng.randrange(0, 40)) + common + own("d", rng.randrange(0, 40))) for _ in range(60)]
    twice = own("t", 70)
    rows.append(" ".join(twice + own("u", 9) + twice))  # repeats in itself only
    rows += [" ".join(["spam"] * 400), " ".join(["SPAM"] * 300), " ".join(["Spam"] * 20)]
    whole = " ".join(own("w", 90))
    rows += [whole, whole, "", "short text"]
    return [(i, t) for i, t in enumerate(rows)] + [(0, rows[0]), (None, rows[-3]), (None, None), (7000, None)]


def spans(df):
    return {(r.doc_id, r.start, r.end) for r in df.collect()}


@pytest.mark.parametrize("partitions", [1, 7, 150])
def test_spans_equal_brute_force(spark, documents, partitions):
    rows = corpus()
    df = rp.repeated_passages(documents(rows).withColumnRenamed("lang", "start").withColumnRenamed("source", "pos"), partitions=partitions)
    assert spans(df) == brute(rows)


def test_partner_holds_part_of_the_passage(spark, documents):
    rows = [r for r in corpus() if r[0] is not None]
    texts = dict(rows)
    for r in rp.repeated_passages(documents(rows)).collect():
        mine, theirs = texts[r.doc_id].lower().split(), texts[r.other_doc_id].lower().split()
        piece = theirs[r.other_start : r.other_start + rp.MIN_WORDS]
        assert any(mine[i : i + rp.MIN_WORDS] == piece for i in range(r.start, r.end - rp.MIN_WORDS + 1))


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert spans(op9_repeated_passages(spark, sf_dir)) == brute(rows)


def test_empty(spark, documents):
    assert rp.repeated_passages(documents([])).count() == 0
    assert rp.repeated_passages(documents([(1, "a b")])).count() == 0


def test_equal_passages_retain_equal_positions():
    rng = np.random.default_rng(0)
    for _ in range(200):
        passage = rng.integers(0, 1 << 63, rp.MIN_WORDS, dtype=np.uint64)
        found = []
        for _ in range(2):
            before = rng.integers(0, 80)
            words = np.concatenate([rng.integers(0, 1 << 63, before, dtype=np.uint64), passage, rng.integers(0, 1 << 63, rng.integers(0, 80), dtype=np.uint64)])
            inside = {int(p) - before for p in rp.retained(words) if before <= p <= before + rp.MIN_WORDS - rp.PREFIX}
            found.append(inside)
        assert found[0] & found[1]


@pytest.mark.parametrize("partitions", [1, 7])
def test_passages_that_end_in_a_common_phrase(spark, documents, partitions):
    """Two documents share own words and a phrase that many others hold, before or after other words."""
    rng = random.Random(11)
    own = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts = []
    for own_words in (8, 15, 25, 60):
        for ahead in (True, False):
            phrase = own(45)
            for _ in range(3):
                passage = own(own_words) + phrase if ahead else phrase + own(own_words)
                texts += [own(30) + passage + own(30), own(5) + passage + own(70)]
            texts += [own(20) + phrase + own(20) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert spans(rp.repeated_passages(documents(rows), partitions=partitions)) == brute(rows)
