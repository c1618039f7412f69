import base64
import gzip
import hashlib
import io
import random

import pytest

from ebbline.llm import files, warc
from ebbline.llm.queries import ORACLES, op2_warc_writer
from tests.compare import oracle_connection, oracle_rows, schema_differences, spark_rows

PAGE = "page_id long, url string, html string"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        revisit = len(payload) >= min_bytes and first is not None and (page_id is None or page_id > first)
        out.append((page_id, len(payload), sha(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def pages():
    rng = random.Random(6)
    rows = [(rng.randrange(-500, 10**6), f"http://x/{i}\n", rng.choice(["<p>hot</p>", f"<p>é {i}</p>" * rng.randrange(40)])) for i in range(300)]
    return rows + [(None, None, "<p>hot</p>"), (None, None, None), (7, None, ""), (8, "u", None), (9, "u", "WARC/1.1\r\n\r\n"), (10, "u", "z" * 200_000), (10, "u", "z" * 200_000), (11, "u", "only"), (None, "u", "null only"), (None, "v", "null only")]


def written(spark, rows, **settings):
    df = spark.createDataFrame(rows, PAGE).withColumn("record_type", warc.F.lit("x")).withColumn("_first", warc.F.lit(1))
    folder = files.new_folder(spark, "warc")
    return warc.write_warc(df, folder, **settings), folder


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize("min_bytes", [0, 15])
def test_round_trip(spark, monkeypatch, min_bytes):
    monkeypatch.setattr(files, "SMALL_SHARD_BYTES", 4000)
    rows = pages()
    manifest, folder = written(spark, rows, min_bytes=min_bytes, roll_bytes=700)
    back = warc.read_warc(manifest, folder, payloads=True)
    assert found(back) == expected(rows, min_bytes)
    for r in back.collect():
        assert r.payload is None if r.record_type == "revisit" else sha(r.payload.decode()) == r.payload_digest
    parts = manifest.collect()
    assert len({m.shard for m in parts}) > 3 and max(m.part for m in parts) > 0


def test_files_are_warc_and_do_not_change(spark, monkeypatch):
    monkeypatch.setattr(files, "SMALL_SHARD_BYTES", 4000)
    rows = [r for r in pages() if r[0] is not None]
    one, folder = written(spark, rows, roll_bytes=2000)
    two, other = written(spark, rows[::-1], roll_bytes=2000)
    listed = sorted(tuple(r) for r in one.collect())
    assert listed == sorted(tuple(r) for r in two.collect())
    fs, base = files.file_system(folder)
    last = None
    for m in sorted(one.collect(), key=lambda m: (m.shard, m.part)):
        with fs.open_input_file(f"{base}/{m.name}") as file:
            data = file.read()
        assert hashlib.sha256(data).hexdigest() == m.sha256 and len(data) == m.bytes
        text = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
        assert text.count(b"WARC-Record-ID: ") == m.records
        for member in warc.members(io.BytesIO(data)):
            page = warc.parse_record(member)["page_id"]
            assert last is None or page >= last
            last = page


def test_damage_is_seen(spark):
    record = warc.build_record(3, "u", b"payload", None)
    assert warc.parse_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload\r\n\r\n", b"paxload\r\n\r\n"))


def test_empty_table(spark):
    manifest, folder = written(spark, [])
    assert manifest.count() == 0 and warc.read_warc(manifest, folder).count() == 0


def test_query_matches_sql(spark, sf_dir):
    con, sql = oracle_connection(sf_dir), ORACLES["op2_warc_writer"]
    df = op2_warc_writer(spark, sf_dir)
    assert schema_differences(df, con, sql) == []
    assert spark_rows(df) == oracle_rows(con, sql)
