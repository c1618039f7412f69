import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbline.llm import files, queries
from ebbline.llm import fingerprints as fp


def brute_digest(data):
    """Triplet by triplet, with the quartiles read off the sorted counts."""
    counts = [0] * fp.BUCKETS
    for i in range(fp.WINDOW - 1, len(data)):
        for a, b in fp.PAIRS:
            counts[fp._TABLES[0][data[i]] ^ fp._TABLES[a][data[i - a]] ^ fp._TABLES[b][data[i - b]]] += 1
    q = [sorted(counts)[fp.BUCKETS * k // 4 - 1] for k in (1, 2, 3)]
    ratios = [15 * q[0] // q[2], 15 * q[1] // q[2]] if q[2] else [0, 0]
    return [min(255, round(fp.LENGTH_STEPS * np.log2(len(data) + 1))), *ratios, *(sum(c > x for x in q) for c in counts)]


def brute_near(a, b):
    apart = [abs(int(x) - int(y)) for x, y in zip(a, b)]
    d = fp.LENGTH_WEIGHT * apart[0] + fp.RATIO_WEIGHT * (apart[1] + apart[2]) + sum((0, 1, 2, 6)[x] for x in apart[3:])
    return 1 - min(d, fp.LIMIT) / fp.LIMIT


def brute(rows):
    def place(row):
        return (row[0] is not None, row[0] or 0)

    rows = sorted(((i, t or "") for i, t in rows), key=place)
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = (text[: len(text) - half] + after[:half]).encode()
        own, other, following = (brute_digest(x) for x in (text.encode(), changed, after.encode()))
        marks = [fp.to_text(np.array(x, np.uint8)) for x in (own, other)]
        out.append((i, len(text), hashlib.sha256(changed).hexdigest(), *marks, round(brute_near(own, other), 9), round(brute_near(own, following), 9)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300))
def test_digest(text):
    data = text.encode()
    assert fp.digest(data).tolist() == brute_digest(data)
    assert fp.from_text(fp.to_text(fp.digest(data))).tolist() == brute_digest(data)


def test_blocks_of_a_long_text_add_up(monkeypatch):
    data = bytes(np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8))
    whole = fp.bucket_counts(data)
    monkeypatch.setattr(fp, "BLOCK", 7)
    assert (fp.bucket_counts(data) == whole).all() and whole.sum() == 6 * 4996


def test_difference_is_bounded_and_symmetric():
    texts = ["", "a", "the quick brown fox jumps over the lazy dog " * 5, "völlig andere Wörter stehen hier " * 9, "\x00" * 1000]
    marks = [fp.digest(t.encode()) for t in texts]
    for a in marks:
        assert fp.difference(a, a) == 0
        for b in marks:
            assert 0 <= fp.difference(a, b) == fp.difference(b, a) <= fp.LIMIT


ROWS = [(5, "plain words stand in this text " * 4), (1, None), (2, ""), (9, "é" * 3), (-4, "other words " * 30), (7, "plain words stand in this text " * 4), (None, "no id at all, still a text"), (3, "x"), (1 << 60, "tail text of the table " * 8)]


def test_rows_equal_brute_force(spark, documents):
    df = documents(ROWS).withColumnRenamed("lang", "_shard").withColumnRenamed("source", "fingerprint").withColumnRenamed("n_chars", "a.b")
    assert found(fp.compared(df)) == brute(ROWS)
    assert found(fp.compared(documents(ROWS[:1]))) == brute(ROWS[:1])
    assert found(fp.compared(documents([]))) == []
    marks = {r.doc_id: r.fingerprint for r in fp.fingerprints(df).collect()}
    assert marks[5] == marks[7] == fp.to_text(fp.digest(ROWS[0][1].encode())) and marks[1] == marks[2]


def test_many_shards_and_repeated_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(files, "SMALL_SHARD_BYTES", 60)
    rng = np.random.default_rng(3)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(int(i), " ".join(rng.choice(words, int(rng.integers(0, 40))))) for i in rng.permutation(300)]
    assert found(fp.compared(documents(rows))) == brute(rows)
    copies = rows[:40] + [(7, "the same row")] * 30
    assert found(fp.compared(documents(copies).repartition(5))) == brute(copies)


def test_query(spark, sf_dir):
    got = found(queries.QUERIES["op12_fingerprints"](spark, sf_dir))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got == brute(rows)
    assert sum(g[5] > g[6] for g in got) > 0.95 * len(got)
