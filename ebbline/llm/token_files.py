"""Token ids of documents in binary files whose document boundaries are Elias-Fano coded.

File format (little-endian): the ids of all documents one after another, 2 or 4 bytes each; then the Elias-Fano
code of the boundaries (the number of ids up to the end of each document) and that of the document ids; last a
footer of FOOTER with the sizes and ``MAGIC``. A sequence of n non-decreasing values below u takes n * (2 + log2(u / n))
bits: the low bits of each value are packed, the high parts are a bit vector in which the i-th one stands at position
high_i + i. ``select(i)`` finds the i-th one from sampled positions, so a document's offset needs no table of 64-bit numbers.

Rows are written in ascending order of the document id (nulls first, equal ids by a hash of the text), every text ends with
the end id. A null or empty text holds the end id only. Repeated rows are written as often as they occur. Columns other than
the two named ones are not read.
"""

from __future__ import annotations

import functools
import json
import os
import re
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ebbline.llm import files
from ebbline.llm.common import bounded, slices
from ebbline.session import stage

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
MAGIC = b"EFTOKEN1"
#: Ids, documents, null document ids, bytes per id, bytes of either code.
FOOTER = struct.Struct("<qqqqqq8s")
READ_BYTES = 4 << 20
#: Chunks after which a new generation of remembered ones begins; two are kept, some 200 bytes a chunk.
GENERATION = 400_000
#: Chunks that are learned at a time, and how many of them are joined to a string.
AT_ONCE, JOINED = 20_000, 100
SIGNS = string.punctuation
#: Chunks whose ids are put together at a time.
GATHERED = 1 << 18


class EliasFano:
    """A non-decreasing sequence of numbers of at least 0."""

    SAMPLE = 256
    #: Values whose low bits are packed at a time; a multiple of 8.
    BLOCK = 1 << 15

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.ones: np.ndarray | None = None

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8))
        if np.any(values[1:] < values[:-1]):
            raise ValueError("values must not decrease")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        blocks = [np.packbits(((values[i : i + cls.BLOCK, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") for i in range(0, n, cls.BLOCK)]
        low = np.concatenate(blocks)
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1, np.uint8)
        high[at] = 1
        return cls(n, low_bits, low, np.packbits(high, bitorder="little"))

    def _low(self, i: int) -> int:
        bits = np.unpackbits(self.low[i * self.low_bits // 8 : ((i + 1) * self.low_bits + 7) // 8], bitorder="little")
        skip = i * self.low_bits % 8
        return int(sum(int(b) << k for k, b in enumerate(bits[skip : skip + self.low_bits])))

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        if self.ones is None:  # bytes before which each SAMPLE-th one lies
            counts = np.cumsum(np.unpackbits(self.high.reshape(-1, 1), axis=1).sum(axis=1))
            self.ones = np.searchsorted(counts, np.arange(0, self.n, self.SAMPLE), "right")
        byte = int(self.ones[i // self.SAMPLE])
        left = i - i // self.SAMPLE * self.SAMPLE
        first = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))
        # ones of this byte that come before the sampled one
        before = int(np.unpackbits(self.high[:byte]).sum()) if byte else 0
        left += i // self.SAMPLE * self.SAMPLE - before
        while left >= len(first):
            left -= len(first)
            byte += 1
            first = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))
        return ((byte * 8 + int(first[left]) - i) << self.low_bits) | self._low(i)

    def decode(self) -> np.ndarray:
        """All values."""
        if not self.n:
            return np.zeros(0, np.uint64)
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        shifts = np.arange(self.low_bits, dtype=np.uint64)
        for i in range(0, self.n, self.BLOCK):
            part = high[i : i + self.BLOCK]
            first = i * self.low_bits // 8
            bits = np.unpackbits(self.low[first : first + (len(part) * self.low_bits + 7) // 8], bitorder="little")[: len(part) * self.low_bits]
            part |= (bits.reshape(len(part), self.low_bits).astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)
        return high

    def to_bytes(self) -> bytes:
        return struct.pack("<qqq", self.n, self.low_bits, len(self.low)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, size = struct.unpack_from("<qqq", data)
        body = np.frombuffer(data, np.uint8, offset=24)
        return cls(n, low_bits, body[:size], body[size:])


class Encoder:
    """Ids of whole texts, each distinct chunk passed to the tokenizer once while it is remembered.

    A byte-level tokenizer first cuts a text by a pattern under which a space in front of a character that is no white
    space always begins a new part, and codes the parts one by one. So a text may be cut there as well and
    the ids of the chunks joined.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        # a token of a byte-level vocabulary has one character for each byte
        self.id_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())], np.int64)
        self.model = self.tokenizer.model
        self.bare: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind = spec.get("pre_tokenizer") or {}
        self.by_chunk = kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space") and not spec.get("normalizer")

    def ids(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(found, f"<u{self.width}").tobytes()

    def can_cut(self, text: str) -> bool:
        return self.by_chunk and not any(s in text for s in self.special)

    def known(self, stems: list[str]) -> list[bytes]:
        """The ids of chunks with a space before them, learned where they are not remembered."""
        if len(self.chunks) > GENERATION:  # what is not asked for again goes with the older generation
            self.older, self.chunks = self.chunks, {}
        found = list(map(self.chunks.get, stems))
        missing = [i for i, ids in enumerate(found) if ids is None]
        fresh = []
        for stem in dict.fromkeys([stems[i] for i in missing]):
            ids = self.older.get(stem)
            if ids is None:
                fresh.append(stem)
            else:
                self.chunks[stem] = ids
        self.learn(fresh)
        for i in missing:
            found[i] = self.chunks[stems[i]]
        return found

    def letters(self, part: str) -> list[int]:
        """The ids of a space and letters or of letters alone: one part, which goes straight to the tokenizer's model, its bytes
        written as the vocabulary does."""
        return [t.id for t in self.model.tokenize(part.translate(_AS_BYTES))]

    def learn(self, fresh: list[str]) -> None:
        others, tokenize = [], self.model.tokenize
        for i in range(0, len(fresh), AT_ONCE):
            words, ids, ends = [], [], []
            for stem in fresh[i : i + AT_ONCE]:
                if stem.isascii() and stem.isalpha():  # most
                    ids += [t.id for t in tokenize("\u0120" + stem)]
                elif _LETTERS.fullmatch(stem):
                    ids += self.letters(f" {stem}")
                elif lines := _TWO_LINES.fullmatch(stem):
                    ids += self.letters(f" {lines[1]}")
                    ids += np.frombuffer(self.without_space([lines[2]])[0], f"<u{self.width}").tolist()
                    ids += self.letters(lines[3])
                else:
                    others.append(stem)
                    continue
                words.append(stem)
                ends.append(len(ids) * self.width)
            data = np.array(ids, f"<u{self.width}").tobytes()
            self.chunks.update(zip(words, [data[a:b] for a, b in zip([0, *ends], ends)]))
        for i in range(0, len(others), AT_ONCE):
            part = others[i : i + AT_ONCE]
            # Long strings cost the tokenizer far less than many short ones; the ids are cut where the bytes end.
            strings = ["".join(f" {c}" for c in part[k : k + JOINED]) for k in range(0, len(part), JOINED)]
            ids = np.concatenate([np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)])
            ends = np.cumsum([len(c.encode()) + 1 for c in part])
            reached = np.cumsum(self.id_bytes[ids])
            at = np.searchsorted(reached, ends)
            if not np.array_equal(reached[at], ends):
                raise ValueError("the tokenizer joined chunks")
            data, first = ids.astype(f"<u{self.width}").tobytes(), 0
            for chunk, last in zip(part, ((at + 1) * self.width).tolist()):
                self.chunks[chunk] = data[first:last]
                first = last

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text. Arrow cuts the texts and numbers their distinct chunks, so that Python handles each of these once."""
        kinds = [(2 if _ODD_SPACE.search(t) else 1) if self.can_cut(t) else 0 for t in texts]
        plain = pc.split_pattern(pa.array([t for t, kind in zip(texts, kinds) if kind == 1], pa.string()), " ")
        odd = pa.array([re.split(r" (?=\S)", t) for t, kind in zip(texts, kinds) if kind == 2], plain.type)
        ids = [self.ids_of_cut(plain), self.ids_of_cut(odd)]
        for text, kind in zip(texts, kinds):
            yield next(ids[kind - 1]) if kind else self.ids(text)

    def ids_of_cut(self, texts: pa.ListArray) -> Iterator[bytes]:
        """The ids of texts cut into chunks without the space in front of all but the first."""
        if not len(texts):
            return
        values, firsts = texts.flatten(), texts.offsets.to_numpy()
        heads = self.without_space(_strings(values.take(texts.offsets[:-1])))
        later = np.ones(len(values), bool)
        later[firsts[:-1]] = False
        coded = values.filter(pa.array(later)).dictionary_encode()
        known = self.ids_of_chunks(coded.dictionary)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.width
        begins, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(known), f"<u{self.width}")
        places = coded.indices.to_numpy()
        ends = np.zeros(len(places) + 1, np.int64)
        np.cumsum(sizes[places], out=ends[1:])
        ends = (ends[firsts - np.arange(len(firsts))] * self.width).tolist()  # of each text
        data = b"".join(self._gather(ids, begins, sizes, places[i : i + GATHERED]) for i in range(0, len(places), GATHERED))
        for head, first, last in zip(heads, ends, ends[1:]):
            yield head + data[first:last]

    def ids_of_chunks(self, chunks: pa.StringArray) -> list[bytes]:
        """The ids of distinct chunks. Signs at the end of a word are a part of their own, so only the word is learned."""
        trimmed = pc.ascii_rtrim(chunks, characters=SIGNS)
        words = pc.if_else(pc.match_substring_regex(trimmed, f"[0-9{_LATIN}]$"), trimmed, chunks)
        stems = _strings(words)
        known = self.known(stems)
        signed = pc.not_equal(pc.binary_length(chunks), pc.binary_length(words)).to_numpy(zero_copy_only=False).nonzero()[0]
        tails = [c[len(stems[i]) :] for i, c in zip(signed.tolist(), _strings(chunks.take(pa.array(signed))))]
        for i, tail in zip(signed.tolist(), self.without_space(tails)):
            known[i] += tail
        return known

    def without_space(self, texts: list[str]) -> list[bytes]:
        """The ids of short strings that occur often."""
        bounded(self.bare)
        fresh = list(set(texts).difference(self.bare))
        for text, found in zip(fresh, self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)):
            self.bare[text] = np.array(found.ids, f"<u{self.width}").tobytes()
        return [self.bare[t] for t in texts]

    @staticmethod
    def _gather(ids: np.ndarray, begins: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> bytes:
        """The ids of the chunks at ``places``, one after another."""
        n = sizes[places]
        ends = np.cumsum(n)
        return ids[np.arange(ends[-1]) + np.repeat(begins[places] - ends + n, n)].tobytes()


_ODD_SPACE = re.compile(r" (?:\s|$)")
#: Letters of the Latin script, which no version of Unicode takes for anything else, and their bytes as a byte-level vocabulary writes them.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LETTERS = re.compile(f"[{_LATIN}]+")
#: A word, signs and the end of its line, a word.
_TWO_LINES = re.compile(f"([{_LATIN}]+)([{re.escape(string.punctuation)}]*\n)([{_LATIN}]+)")
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTE_SIGNS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)).difference(_SHOWN)))}
_AS_BYTES = {c: "".join(_BYTE_SIGNS[b] for b in chr(c).encode()) for c in [0x20, *range(0xC0, 0x250)]}


def _strings(column: pa.StringArray) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


class ShardFile:
    """Writes one file of the format."""

    def __init__(self, folder: str, shard: int, width: int) -> None:
        self.name, self.width = f"tokens-{shard:08d}.bin", width
        self.draft = files.Draft(folder, self.name)
        self.shard, self.ids, self.nulls = shard, 0, 0
        self.ends: list[int] = []
        self.docs: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.draft.write(ids)
        self.ids += len(ids) // self.width
        self.ends.append(self.ids)
        if doc_id is None:
            self.nulls += 1
        else:
            self.docs.append(doc_id)

    def close(self) -> dict:
        ends = EliasFano.encode(np.array(self.ends, np.uint64)).to_bytes()
        # two's complement order: -2^63 becomes 0
        docs = EliasFano.encode((np.array(self.docs, np.int64).view(np.uint64) ^ np.uint64(1 << 63)) - np.uint64(self._base())).to_bytes()
        docs = struct.pack("<Q", self._base()) + docs
        self.draft.write(ends + docs)
        self.draft.write(FOOTER.pack(self.ids, len(self.ends), self.nulls, self.width, len(ends), len(docs), MAGIC))
        self.draft.publish()
        return {"shard": self.shard, "name": self.name, "documents": len(self.ends), "ids": self.ids, "bytes": self.draft.bytes}

    def _base(self) -> int:
        return self.docs[0] + (1 << 63) if self.docs else 0


def read_file(folder: str, name: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """Document id, offset in the file and ids of every document of a file, in order."""
    fs, base = files.file_system(folder)
    with fs.open_input_file(f"{base}/{name}") as file:
        size = file.size()
        ids, documents, nulls, width, ends_bytes, docs_bytes, magic = FOOTER.unpack(file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{name} is no token file")
        tail = file.read_at(ends_bytes + docs_bytes, ids * width)
        ends = EliasFano.from_bytes(tail[:ends_bytes]).decode().astype(np.int64)
        keys = EliasFano.from_bytes(tail[ends_bytes + 8 :]).decode() + np.uint64(struct.unpack_from("<Q", tail, ends_bytes)[0])
        docs = [None] * nulls + (keys ^ np.uint64(1 << 63)).view(np.int64).tolist()
        starts = np.concatenate([[0], ends[:-1]]) if documents else ends
        first = 0
        while first < documents:  # as many documents as fit a read, one at least
            last = max(first + 1, int(np.searchsorted(ends, starts[first] + READ_BYTES // width, "right")))
            block = np.frombuffer(file.read_at(int(ends[last - 1] - starts[first]) * width, int(starts[first]) * width), f"<u{width}")
            for i in range(first, last):
                yield docs[i], int(starts[i]), block[starts[i] - starts[first] : ends[i] - starts[first]]
            first = last


def read_document(folder: str, name: str, i: int) -> np.ndarray:
    """The ids of the i-th document of a file through ``select``, without decoding the other boundaries."""
    fs, base = files.file_system(folder)
    with fs.open_input_file(f"{base}/{name}") as file:
        size = file.size()
        ids, _, _, width, ends_bytes, _, _ = FOOTER.unpack(file.read_at(FOOTER.size, size - FOOTER.size))
        ends = EliasFano.from_bytes(file.read_at(ends_bytes, ids * width))
        start = ends.select(i - 1) if i else 0
        return np.frombuffer(file.read_at((ends.select(i) - start) * width, start * width), f"<u{width}")


def write_token_files(df: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write the files and return the committed manifest: shard, name, documents, ids, bytes, and ``start``, the
    number of ids in all earlier files."""
    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    tie = F.xxhash64("_text")
    shards, place = files.sharder(rows, "_id", tie, F.octet_length("_text"))
    placed = rows.withColumn("_tie", tie).withColumn("_shard", place(F.col("_id"), F.col("_tie")))
    ordered = placed.repartition(shards, "_shard").sortWithinPartitions("_shard", F.col("_id").asc_nulls_first(), "_tie").select("_shard", "_id", "_text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        open_file: ShardFile | None = None
        done = []
        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column("_text").to_pylist()
            for shard, doc_id, ids in zip(batch.column("_shard").to_pylist(), batch.column("_id").to_pylist(), encoder.encode(texts)):
                if open_file is None or open_file.shard != shard:
                    if open_file is not None:
                        done.append(open_file.close())
                    open_file = ShardFile(folder, shard, encoder.width)
                open_file.add(doc_id, ids + end)
        if open_file is not None:
            done.append(open_file.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("shard", pa.int32()), ("name", pa.string()), ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())]))

    manifest = stage(ordered.mapInArrow(write, "shard int, name string, documents long, ids long, bytes long"), "token-manifest")
    # one row per file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as 4-byte numbers) of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                rows = [(doc_id, file["start"] + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc_id, at, ids in read_file(folder, file["name"])]
                if len(rows) != file["documents"]:
                    raise ValueError(f"{file['name']} does not hold what its manifest says")
                columns = list(zip(*rows)) or [()] * 4
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.select("name", "documents", "start").repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
