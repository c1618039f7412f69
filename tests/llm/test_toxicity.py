import itertools
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ebbline.llm import toxicity as tx
from ebbline.llm.common import slices
from ebbline.llm.queries import op6_toxicity


def plain_value(a, b):
    """Sum over all subsequences of three characters of the products of their weights, a's cut at b's, over K(b, b)."""
    def weights(s):
        out = {}
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i < tx.SPAN:
                key = tuple(tx.coded(s)[[i, j, k]])
                out[key] = out.get(key, 0) + tx.DECAY ** (k - i + 1)
        return out

    x, y = weights(a), weights(b)
    return sum(min(v, y.get(key, 0)) * y.get(key, 0) for key, v in x.items()) / sum(v * v for v in y.values())


def test_values_equal_the_kernel():
    landmarks = ["^idiot$", "^lowei", "^chón"]
    words = ["^idiot$", "^idxiot$", "^i0diot$", "^loweischaft$", "^chónñ$", "^th$", "^$", "^chonn$", "^" + "idiot" * 9 + "$"]
    got = tx.Kernel(landmarks).values(words)
    for word, row in zip(words, got):
        for z, value in zip(landmarks, row):
            want = max(plain_value(p, z) for p in tx.pieces(word))
            assert value == pytest.approx(want if want >= tx.FLOOR else 0, abs=1e-5)


def test_gaps_and_inserted_characters_are_tolerated():
    kernel = tx.Kernel(["^idiot$", "^worthless$"])
    found = lambda text: tx.TextKernel(kernel).values([text.encode()])[0, :2].max() ** 0.5
    for text in ("an idiot", "an id.i-ot!", "an i d i o t here", "an idxiot", "IDIIOT", "w o r t h l e s s", "wor*thless", "worxthless"):
        assert found(text) >= 0.7, text
    for text in ("", "a b", "the people thought it worth a thing", "idea video radio", "x" * 50_000, "idle riot"):
        assert found(text) < 0.6, text


def corpus(n=1500):
    rng = random.Random(8)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "or"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 120))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["blimpfoo", "zugzwax", "krotz" + word()]))
        docs.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, 1, toxic))
        elif toxic and i % 2:
            docs[-1] = (i, docs[-1][1].replace("zugzwax", "zug-z.wax").replace("blimpfoo", "blimxpfoo"))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_leaks(spark):
    docs, labels = corpus()
    d, lab = frames(spark, docs, labels)
    got = {r.doc_id: r for r in tx.toxicity(d.withColumn("score", d.text), lab).collect()}
    assert len(got) == len(docs)
    held = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in got if got[i].held_out} == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [got[i].predicted == t for i, t in held]
    assert np.mean(right) > 0.95
    # labels of held-out rows change nothing
    turned = [(i, q, 1 - t if (i, t) in held else t) for i, q, t in labels]
    again = {r.doc_id: r.score for r in tx.toxicity(d, frames(spark, docs, turned)[1]).collect()}
    assert again == {i: r.score for i, r in got.items()}
    # rejected rows go, the others keep their columns
    kept = tx.clean_rows(d.withColumn("extra", d.doc_id), lab)
    assert kept.columns == ["doc_id", "text", "extra"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_odd_rows(spark):
    docs, labels = corpus(400)
    docs += [(9000, None), (9001, ""), (None, "blimpfoo zugzwax"), (3, docs[3][1]), (9002, "er " * 50_000), (9003, "e" * 100_000)]
    labels += [(None, 1, 1), (9000, 1, None), (5, 1, 0), (5, 1, 1)]
    rows = tx.toxicity(*frames(spark, docs, labels)).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    score = {r.doc_id: r.score for r in rows}
    assert score[9000] == score[9001] < 0.5 and not [r for r in rows if r.doc_id is None][0].held_out


@pytest.mark.parametrize("toxic", [0, 1, None])
def test_without_both_classes(spark, toxic):
    rows = [(i, "a b") for i in range(9)]
    labels = [] if toxic is None else [(i, 1, toxic) for i in range(9)]
    assert {(r.score, r.predicted) for r in tx.toxicity(*frames(spark, rows, labels)).collect()} == {(float(toxic or 0), toxic or 0)}
    assert tx.toxicity(*frames(spark, [], labels)).count() == 0


def test_query(spark, sf_dir):
    rows = op6_toxicity(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def rare(n, insults):
    """Texts of which a fifth is toxic, each insult held by few of them."""
    rng = random.Random(3)
    common = [f"word{i}x" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 5 == 0)
        words = rng.choices(common, k=20) + ([f"{rng.choice(insults)}"] if toxic else [])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_rare_insults_are_learned(spark):
    insults = ["".join(random.Random(k).choices("bcdfgklmnprstvz", k=3) + random.Random(k + 999).choices("aeiou", k=1) + random.Random(k + 77).choices("bdgkpqxz", k=4)) for k in range(150)]
    docs, labels = rare(6000, insults)
    got = tx.toxicity(*frames(spark, docs, labels)).where("held_out").collect()
    truth = {i: t for i, _, t in labels}
    found = [r.predicted for r in got if truth[r.doc_id]]
    wrong = [r.predicted for r in got if not truth[r.doc_id]]
    assert np.mean(found) > 0.35 and np.mean(wrong) < 0.02


def test_score_without_landmarks_is_the_share_of_all_labels(spark, monkeypatch):
    monkeypatch.setattr(tx, "choose_landmarks", lambda *_: [])
    docs, labels = rare(1000, ["blimp"])
    model = tx.train(*frames(spark, docs, labels), rows=50)
    usable = [t for i, _, t in labels if zlib.crc32(str(i).encode()) % 5]
    assert model.share == pytest.approx(np.mean(usable)) and model.share < 0.5


def test_texts_are_scored_in_small_slices():
    batch = pa.RecordBatch.from_pydict({"_text": ["x" * 300_000] * 12 + [None, "y" * 5_000_000]})
    parts = list(slices(batch, most=tx.SCORED_BYTES))
    assert pa.Table.from_batches(parts).column("_text").to_pylist() == batch.column("_text").to_pylist()
    assert all(p.num_rows == 1 or p.column("_text").nbytes < 2 * tx.SCORED_BYTES for p in parts if p.column("_text")[-1].as_py() != "y" * 5_000_000)
    assert len(parts) > len(list(slices(batch)))


def test_words_take_little_memory():
    """Words near a landmark are remembered by the few values that they have, and few triples meet all landmarks at a time."""
    rng = random.Random(5)
    stems = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=14)) for _ in range(250)]
    kernel = tx.Kernel([f"^{s}$" for s in stems])
    words = [s[:k] + c + s[k:] for s in stems for k in (4, 6, 8, 10) for c in "xy"]
    texts = [" ".join(words[i : i + 100]).encode() for i in range(0, len(words), 100)]
    scorer = tx.TextKernel(kernel)
    tracemalloc.start()
    got = scorer.values(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for text, value in zip(texts, got):
        squares = np.square(kernel.values([tx.normal(w) for w in set(text.split())]))
        assert value[:250] == pytest.approx(squares.max(axis=0), abs=1e-4) and value[250:500] == pytest.approx(np.log1p(squares.sum(axis=0)) / 4, abs=1e-4)
    assert len(scorer.near) == len(set(words)) and sum(len(x) for entry in scorer.near.values() for x in entry) < 100 * len(words)
    assert peak < 60 << 20
