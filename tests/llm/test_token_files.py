import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbline.llm import files, token_files as tf
from ebbline.llm.queries import op7_token_files

PATH = public_tokenizers.path(tf.TOKENIZER)


@given(st.lists(st.integers(0, 1 << 40), max_size=700))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    values = sorted(values)
    code = tf.EliasFano.from_bytes(tf.EliasFano.encode(np.array(values, np.uint64)).to_bytes())
    assert code.decode().tolist() == values
    assert [code.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small_and_checks_order():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 50_000)).astype(np.uint64)
    assert len(tf.EliasFano.encode(ends).to_bytes()) * 8 < len(ends) * (3 + np.log2(int(ends[-1]) / len(ends)))
    assert tf.EliasFano.encode(ends).decode().tolist() == ends.tolist()
    with pytest.raises(ValueError):
        tf.EliasFano.encode(np.array([2, 1]))


@given(st.lists(st.text(alphabet="ab1 \n\t\r\xa0 \x1cé'!.<|endoftext|>漢", max_size=40), max_size=8))
@settings(max_examples=200, deadline=None)
def test_chunks_give_the_ids_of_the_whole_text(texts):
    plain = Tokenizer.from_file(PATH)
    encoder = tf._encoder(PATH)
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.lists(st.text(alphabet="aZéøɏɐ×ªß1²_'-.,\n\n  ", max_size=40), max_size=8))
@settings(max_examples=200, deadline=None)
def test_words_signs_and_lines_give_the_ids_of_the_whole_text(texts):
    plain = tf._encoder(PATH).tokenizer
    encoder = tf._encoder(PATH)
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_word_is_learned_once_whatever_signs_follow_it():
    encoder = tf.Encoder(PATH)
    list(encoder.encode(["Some wörd, wörd. (wörd) wörd!! wörd", "A wörd; x-y, x-y"]))
    assert set(encoder.chunks) == {"wörd", "(wörd", "x-y"}


def expected(rows):
    plain, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_matches_plain_encoding(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    assert sorted(tuple(r) for r in op7_token_files(spark, sf_dir).collect()) == expected(rows)


def test_nulls_ties_long_texts_and_clashing_columns(spark, documents, save, monkeypatch):
    monkeypatch.setattr(files, "SMALL_SHARD_BYTES", 500)
    random.seed(1)
    rows = [(i * 7 - 50, " ".join(random.choices(["ab", "cd  ", "é\n", "x" * 30], k=random.randint(0, 60)))) for i in range(80)]
    rows += [(-(1 << 63), "low"), ((1 << 63) - 1, "high"), (3000, None), (3001, ""), (3002, "z" * 100_000)]
    df = documents(rows).withColumn("start", F.lit(0)).withColumnRenamed("lang", "n_tokens")
    got = sorted(tuple(r) for r in op7_token_files(spark, save(documents=df)).collect())
    assert got == expected(sorted(rows))


def test_repeated_rows_and_null_ids_are_kept(spark, documents, save):
    rows = [(None, "a"), (None, None), (5, "same"), (5, "same"), (4, "b")]
    got = [tuple(r) for r in op7_token_files(spark, save(documents=documents(rows))).collect()]
    assert sorted(r[0] for r in got if r[0] is not None) == [4, 5, 5]
    assert [r[2] for r in got if r[0] is None] in ([1, 2], [2, 1])
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in by_start] == [0, *np.cumsum([r[2] for r in by_start])[:-1]]
    assert [r[0] for r in by_start] == [None, None, 4, 5, 5]


def test_empty_table(spark, documents, save):
    assert op7_token_files(spark, save(documents=documents([]))).collect() == []


def test_one_document_by_select(spark, documents):
    df = documents([(i, "word " * i) for i in range(300)])
    folder = files.new_folder(spark, "tokens")
    manifest = tf.write_token_files(df, PATH, folder)
    file = manifest.orderBy("shard").first()
    listed = list(tf.read_file(folder, file.name))
    for i in (0, 1, len(listed) // 2, len(listed) - 1):
        assert tf.read_document(folder, file.name, i).tolist() == listed[i][2].tolist()
