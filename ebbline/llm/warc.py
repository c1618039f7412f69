"""Deterministic sharded WARC writer and its reader.

Records are sorted by page id in ranges that depend on the rows only, one range per shard. A shard is written as files that
roll when their compressed size reaches a limit; every record is a gzip member of its own. Headers, block and payload
digests, record ids and lengths are made anew from the row. Files get their final names when complete, and the manifest
that Spark commits names the files a reader opens.

Of rows with equal payloads of at least ``min_bytes`` bytes, those with the smallest page id are responses and the others are
revisits that refer to it; a null page id is never the smallest (if a payload has no other, all its rows are
responses). Repeated rows are written as often as they occur. A null html is an empty payload, a null url a name made
of the page id. Columns other than the three named ones are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ebbline.llm import files
from ebbline.session import stage

#: Compressed bytes after which a file is closed and the next one begun.
ROLL_BYTES = 64 << 20
MIN_BYTES = 0
#: Fixed, so that a second run writes the same bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6f0f6c1e-3a0c-5d5c-9b57-0f6d6a3c7f10")
READ_BYTES = 1 << 20
MANIFEST = "shard int, part int, name string, records long, bytes long, sha256 string"


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{payload_digest}')}>"


def header_value(text: str) -> str:
    """A value on one line: control characters and what is not ASCII are percent-coded."""
    return re.sub(r"[^\x20-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "replace")), text)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record: a response with the payload, or a revisit without it."""
    sha = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, sha)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", header_value(url) if url else f"urn:page:{page_id}"),
        ("WARC-Payload-Digest", f"sha1:{sha}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, sha)), ("X-Refers-To-Page", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


class WarcFiles:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int) -> None:
        self.folder, self.shard, self.roll_bytes = folder, shard, roll_bytes
        self.part, self.draft, self.done = 0, None, []

    def add(self, record: bytes) -> None:
        if self.draft is None:
            self.draft = files.Draft(self.folder, f"pages-{self.shard:06d}-{self.part:05d}.warc.gz")
            self.records, self.sha = 0, hashlib.sha256()
        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = squeeze.compress(record) + squeeze.flush()
        self.draft.write(member)
        self.sha.update(member)
        self.records += 1
        if self.draft.bytes >= self.roll_bytes:
            self.close()

    def close(self) -> list[dict]:
        if self.draft is not None:
            self.draft.publish()
            name = self.draft.final.rpartition("/")[2]
            self.done.append({"shard": self.shard, "part": self.part, "name": name, "records": self.records, "bytes": self.draft.bytes, "sha256": self.sha.hexdigest()})
            self.draft, self.part = None, self.part + 1
        return self.done


def _manifest_schema() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def first_pages(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``_id``, ``_sha`` and ``_first`` of the rows that are revisits. Only digests are grouped and joined; the
    groups' table is written first, so that a payload that many rows share can be split by the join."""
    keys = pages.where(F.octet_length("_html") >= min_bytes).select("_id", "_sha")
    groups = keys.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _first IS NOT NULL")
    groups = stage(groups.select("_sha", "_first"), "warc-groups")
    return keys.join(groups, "_sha").where("_id IS NULL OR _id > _first").select("_id", "_sha", "_first").distinct()


def _tie(sha) -> Column:
    """Orders rows of one page id by their digest."""
    return F.conv(F.substring(sha, 1, 15), 16, 10).cast("long")


def write_warc(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archives into ``folder`` and return the committed manifest."""
    pages = df.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("_html"))
    pages = pages.withColumn("_sha", F.sha1("_html"))
    shards, place = files.sharder(pages, "_id", _tie(F.col("_sha")), F.octet_length("_html"))
    # A revisit's note is a row without text that the sort puts right before its page, so the texts are shuffled once.
    notes = first_pages(pages, min_bytes).select("_id", F.lit(None).cast("string").alias("_url"), F.lit(None).cast("binary").alias("_html"), "_sha", F.lit(0).alias("_kind"), "_first")
    rows = pages.withColumns({"_kind": F.lit(1), "_first": F.lit(None).cast("long")}).unionByName(notes).withColumn("_shard", place(F.col("_id"), _tie(F.col("_sha"))))
    ordered = rows.repartition(shards, "_shard").sortWithinPartitions("_shard", F.col("_id").asc_nulls_first(), "_sha", "_kind", "_url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_files: WarcFiles | None = None
        done: list[dict] = []
        noted: tuple | None = None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["_id"], row["_sha"])
                if row["_kind"] == 0:
                    noted = (key, row["_first"])
                    continue
                if shard_files is None or shard_files.shard != row["_shard"]:
                    if shard_files is not None:
                        done += shard_files.close()
                    shard_files = WarcFiles(folder, row["_shard"], roll_bytes)
                refers_to = noted[1] if noted is not None and noted[0] == key else None
                shard_files.add(build_record(row["_id"], row["_url"], row["_html"], refers_to))
        if shard_files is not None:
            done += shard_files.close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_manifest_schema())

    return stage(ordered.select("_shard", "_id", "_sha", "_kind", "_url", "_html", "_first").mapInArrow(write, MANIFEST), "warc-manifest")


def members(file) -> Iterator[bytes]:
    """The gzip members of an open file, one at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], file.read(READ_BYTES)
    while data:
        parts.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(parts)
            data, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
            if data:
                continue
        data = file.read(READ_BYTES)
    if parts and any(parts):
        raise ValueError("the last record is cut off")


def parse_record(record: bytes) -> dict:
    """Fields of a record and its payload, after its lengths and digests have been checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    revisit = fields["WARC-Type"] == "revisit"
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    if not revisit and (fields["WARC-Payload-Digest"] != f"sha1:{digest(payload)}" or len(payload) != int(fields["X-Payload-Length"])):
        raise ValueError(f"damaged payload {fields.get('WARC-Record-ID')}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "payload_bytes": number("X-Payload-Length"),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page"),
        "url": fields["WARC-Target-URI"],
        "payload": None if revisit else payload,
    }


def read_warc(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """A row per record of the files that the manifest names; ``payloads`` adds the html of responses."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"] + ["payload"] * payloads
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string(), "payload": pa.binary()}
    schema = pa.schema([(n, types[n]) for n in names])
    ddl = ", ".join(f"{n} {'binary' if n == 'payload' else 'long' if types[n] == pa.int64() else 'string'}" for n in names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                fs, base = files.file_system(folder)
                rows, held, records = [], 0, 0
                with fs.open_input_stream(f"{base}/{entry['name']}", compression=None) as file:
                    for member in members(file):
                        row = parse_record(member)
                        rows.append({n: row[n] for n in names})
                        records += 1
                        held += len(row["payload"] or b"") if payloads else 100
                        if held >= READ_BYTES * 8:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if records != entry["records"]:
                    raise ValueError(f"{entry['name']} does not hold what its manifest says")
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return manifest.select("name", "records").repartition(max(1, manifest.count())).mapInArrow(read, ddl)
