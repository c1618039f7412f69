"""Alignment of the tokens of two tokenizers by an associative monoid of fragments.

Both vocabularies cut the same bytes, a space and the text: A is a byte-level BPE, whose vocabulary entries are decoded to bytes, B a BPE of pieces with
byte fallback, whose pieces are UTF-8 with U+2581 for a space. Where a token of A and a token of B end at the same byte, a
group ends. All pairs of an A and a B occurrence in a group are links. The count of a pair of ids is the number of documents
(rows) that hold it linked.

A fragment describes a range of the bytes without knowing its neighbours: an open prefix (tokens up to the first common
end), closed groups, and an open suffix (tokens after the last common end). Two neighbours compose by cutting suffix and
prefix at the ends that only both together show; this is associative, the empty fragment is its unit, and a group once closed
never changes, so it need not travel. Ranges of A and B may be cut at different places: A where its pre-tokenizer surely cuts, B
between two characters that no piece holds side by side. A text of at most RANGE_CHARS characters is one range. The ranges of a
longer one are dealt to tasks, and a tree of rounds composes FAN neighbours at a time; only open parts go through it.

Inside a range, words are ranges of their own with no open parts: both tokenizers end a token where white space begins, so a
word's closed groups are computed once while it is remembered, and a text's are those of its words one after another.

Null and empty texts, and texts whose tokens of A or B joined are not the space and the text, have no tokens: their numbers are 0 and
the hash is ''. Strings of special tokens are plain text. Repeated rows are documents of their own; null ids are kept; an empty table
gives an empty one. Columns other than the two named ones are not read. A long text without any place to cut is one range.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbline.llm.common import _arrow_schema, slices
from ebbline.session import stage

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of a range, and fragments that are composed at a time.
RANGE_CHARS, FAN = 1 << 17, 16
#: Words and their characters that a worker remembers; words that are learned at a time, and how many are joined to a string.
WORDS, WORD_CHARS, AT_ONCE, JOINED = 400_000, 16 << 20, 20_000, 200
#: Links of a group that are written out; those of a larger one are counted by its distinct ids.
LARGE = 40_000
#: Pairs of ids that are broadcast at most; their counts reach such a bound that no more can.
COMMON_PAIRS = 400_000
#: A white space after a character that is none ends a token of A. Only signs that both engines of patterns call white space are used.
_WORD = re.compile(r"\s*\S+(?:[^\S \n\t]\s*\S*)*|\s+")
#: Places where A can be cut: white space after something else, and an ASCII sign or digit or a full stop after a letter.
_CUT_A = re.compile(r"(?<=\S)(?=[ \n\t])|(?<=[A-Za-zぁ-ゖァ-ヺ一-鿿가-힣])(?=[0-9!-&(-/:-@\[-`{-~、。，])")
SPACE = "▁"

Ids = np.ndarray


@dataclass(frozen=True)
class Tokens:
    """Ids of A and B and the byte offsets at which they end."""

    a: Ids
    a_ends: np.ndarray
    b: Ids
    b_ends: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([x, y]) for x, y in zip(self.parts(), other.parts())))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_ends, self.b, self.b_ends

    def common_ends(self) -> np.ndarray:
        return np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)

    def cut(self, ends: np.ndarray) -> list[Tokens]:
        """The tokens up to each of ``ends``, and those after the last."""
        i = [0, *np.searchsorted(self.a_ends, ends, "right").tolist(), len(self.a)]
        j = [0, *np.searchsorted(self.b_ends, ends, "right").tolist(), len(self.b)]
        return [Tokens(self.a[i[k] : i[k + 1]], self.a_ends[i[k] : i[k + 1]], self.b[j[k] : j[k + 1]], self.b_ends[j[k] : j[k + 1]]) for k in range(len(ends) + 1)]


def tokens(a=(), a_ends=(), b=(), b_ends=()) -> Tokens:
    return Tokens(*(np.asarray(x, np.int64) for x in (a, a_ends, b, b_ends)))


NONE = tokens()


@dataclass(frozen=True)
class Fragment:
    """``closed`` holds whole groups one after another; they end where both sides do. ``head`` holds everything where no common end
    is known (``tail`` is None)."""

    head: Tokens = NONE
    closed: Tokens = NONE
    tail: Tokens | None = None

    @classmethod
    def of(cls, whole: Tokens) -> Fragment:
        ends = whole.common_ends()
        if not len(ends):
            return cls(whole)
        if len(ends) == 1:
            head, tail = whole.cut(ends)
            return cls(head, NONE, tail)
        return cls(*whole.cut(ends[[0, -1]]))

    def __add__(self, other: Fragment) -> Fragment:
        """The fragment of both ranges, ``other`` after this one."""
        seam = Fragment.of((self.head if self.tail is None else self.tail) + other.head)
        if seam.tail is None:  # still no common end
            return Fragment(self.head, self.closed, seam.head) if self.tail is not None else seam
        tail = other.tail if other.tail is not None else seam.tail  # the other's first common end is the seam's last
        if self.tail is None:
            return Fragment(seam.head, seam.closed + other.closed, tail)
        return Fragment(self.head, self.closed + seam.head + seam.closed + other.closed, tail)

    def whole(self) -> Tokens:
        """The tokens of a whole text; nothing comes before its first group, and its tokens end with it."""
        if self.tail is None or len(self.tail.a) or len(self.tail.b):
            raise ValueError("the tokens of a whole text end with it")
        return self.head + self.closed


@dataclass(frozen=True)
class Groups:
    """The groups of tokens that end together: where they end, their tokens of A and B, their texts, and
    the distinct linked pairs of ids (A << 32 | B) with the group and how often they occur in it."""

    ends: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    texts: list[str]
    codes: np.ndarray
    times: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, whole: Tokens) -> Groups:
        a, b, ends = whole.a, whole.b, whole.common_ends()
        group_a, group_b = np.searchsorted(ends, whole.a_ends), np.searchsorted(ends, whole.b_ends)
        p, q = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        to_a, to_b = [0, *np.cumsum(p).tolist()], [0, *np.cumsum(q).tolist()]
        texts = [f"{','.join(text_a[i:j])}|{','.join(text_b[k:m])}" for i, j, k, m in zip(to_a, to_a[1:], to_b, to_b[1:])]
        large = np.flatnonzero(p * q > LARGE)
        small = ~np.isin(group_a, large)
        each = q[group_a[small]]  # B tokens that an A token is linked with
        at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat((np.cumsum(q) - q)[group_a[small]], each)
        codes, owners, times = [(np.repeat(a[small], each) << 32) | b[at]], [np.repeat(group_a[small], each)], [np.ones(len(at), np.int64)]
        for g in large.tolist():
            x, n_x = np.unique(a[to_a[g] : to_a[g + 1]], return_counts=True)
            y, n_y = np.unique(b[to_b[g] : to_b[g + 1]], return_counts=True)
            codes.append(((x[:, None] << 32) | y).ravel())
            times.append((n_x[:, None] * n_y).ravel())
            owners.append(np.full(len(codes[-1]), g))
        return cls(ends, p, q, texts, np.concatenate(codes), np.concatenate(times), np.concatenate(owners))


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(times, first) if len(first) else times


def byte_alphabet() -> dict[str, int]:
    """The character of every byte in a byte-level vocabulary: printable ones stand for themselves, the others follow U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers of a worker, and the words it remembers."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path_a)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.a_bytes = [bytes(alphabet[c] for c in e) if all(c in alphabet for c in e) else e.encode() for e in entries]
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.pieces.get_piece_size()
        names = [self.pieces.id_to_piece(i) for i in range(size)]
        plain = [n for i, n in enumerate(names) if not (self.pieces.is_byte(i) or self.pieces.is_control(i) or self.pieces.is_unknown(i))]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.pieces.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        #: Characters that some piece holds side by side.
        self.joined = {n[i : i + 2].replace(SPACE, " ") for n in plain for i in range(len(n) - 1)}
        if any(y in " \n\t" and (x != " " or y != " ") for x, y in self.joined) or any("\n" in pair for pair in self.joined):
            raise ValueError("a piece goes on after white space: words can't be cut there")
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.pair_ids: dict[int, int] = {}
        self.forget()

    def encode_a(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)

    def encode_b(self, text: str) -> np.ndarray:
        """``text`` as it is: behind a line feed, which joins with nothing, instead of the space that the model adds."""
        return np.array(self.pieces.encode("\n" + text, num_threads=1)[2:], np.int64) if text else NONE.a

    def range_tokens(self, a_text: str, a_at: int, b_text: str, b_at: int) -> tuple[Tokens, bool]:
        """Tokens of a range of A and one of B, and whether they hold just their bytes."""
        a, b = self.encode_a(a_text), self.encode_b(b_text)
        same = b"".join(map(self.a_bytes.__getitem__, a.tolist())) == a_text.encode() and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == b_text.encode()
        return Tokens(a, a_at + np.cumsum(self.a_sizes[a]), b, b_at + np.cumsum(self.b_sizes[b])), same

    def cuts(self, text: str) -> list[tuple[int, int]]:
        """Places where A and where B can be cut, near every multiple of RANGE_CHARS."""
        out, a, b, n = [], 0, 0, len(text)
        for k in range(RANGE_CHARS, n, RANGE_CHARS):
            if a < k:
                found = _CUT_A.search(text, k)
                a = found.start() if found else n
            if b < k:
                b = next((p for p in range(k, n) if text[p - 1 : p + 1] not in self.joined), n)
            out.append((a, b))
        return out

    # --- words -------------------------------------------------------------------------------------

    def forget(self) -> None:
        """Drop all words. It costs time only."""
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.chars = 0
        self.pair_ids, self.codes = {}, np.zeros(0, np.int64)
        empty = np.zeros(0, np.int64)
        self.n_a = self.n_b = self.n_groups = self.n_links = self.n_pairs = self.first = self.pairs = self.times = empty
        self.good = np.zeros(0, bool)

    def learn(self, words: list[str]) -> None:
        """Groups and links of words that are not remembered."""
        # A word with white space at its end would join the next one; such words stand alone.
        alone = [w for w in words if w[-1].isspace()]
        strings = [[w] for w in alone]
        rest = [w for w in words if not w[-1].isspace()]
        strings += [rest[i : i + JOINED] for i in range(0, len(rest), JOINED)]
        for i in range(0, len(strings), max(1, AT_ONCE // JOINED)):
            self._learn(strings[i : i + max(1, AT_ONCE // JOINED)])

    def _encoded(self, strings: list[list[str]]) -> list[tuple[list[str], np.ndarray, np.ndarray, bool]]:
        whole = ["".join(s) for s in strings]
        a = [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
        b = [np.array(ids[2:], np.int64) for ids in self.pieces.encode(["\n" + w for w in whole], num_threads=1)]
        out = []
        for words, text, x, y in zip(strings, whole, a, b):
            data = text.encode()
            good = b"".join(map(self.a_bytes.__getitem__, x.tolist())) == data and b"".join(map(self.b_bytes.__getitem__, y.tolist())) == data
            if good or len(words) == 1:
                out.append((words, x, y, good))
            else:  # some word is not held by its tokens
                out += self._encoded([[w] for w in words])
        return out

    def _learn(self, strings: list[list[str]]) -> None:
        found = self._encoded(strings)
        words = [w for part in found for w in part[0]]
        good = np.array([part[3] for part in found for _ in part[0]], bool)
        # Words that their tokens do not hold get no tokens here.
        held = [part for part in found if part[3]]
        a, b = (np.concatenate([p[k] for p in held]) if held else NONE.a for k in (1, 2))
        ends = np.cumsum([len(w.encode()) for p in held for w in p[0]], dtype=np.int64)
        whole = Tokens(a, np.cumsum(self.a_sizes[a]), b, np.cumsum(self.b_sizes[b]))
        groups = Groups.of(whole)
        common, p, q = groups.ends, groups.n_a, groups.n_b
        if not np.isin(ends, common, assume_unique=True).all():
            raise ValueError("a token goes on after the end of a word")
        word_of = np.searchsorted(ends, common)
        n = len(ends)
        counts = [np.bincount(word_of, weights=x, minlength=n).astype(np.int64) if len(common) else np.zeros(n, np.int64) for x in (p, q, np.ones(len(common)), p * q)]
        until = [0, *np.cumsum(counts[2]).tolist()]
        texts = iter([";".join(groups.texts[until[w] : until[w + 1]]) for w in range(n)])
        ids = self._pair_ids(groups.codes)
        key, time = _summed((word_of[groups.owners] << 32) | ids, groups.times)
        n_pairs = np.bincount(key >> 32, minlength=n)

        spread = np.full(len(words), -1, np.int64)
        spread[good] = np.arange(n)
        put = lambda x: np.where(good, np.append(x, 0)[spread], 0)
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.concatenate([old, put(new)]) for old, new in zip((self.n_a, self.n_b, self.n_groups, self.n_links), counts))
        first = len(self.pairs) + np.cumsum(n_pairs) - n_pairs
        self.first, self.n_pairs = np.concatenate([self.first, put(first)]), np.concatenate([self.n_pairs, put(n_pairs)])
        self.pairs, self.times = np.concatenate([self.pairs, key & 0xFFFFFFFF]), np.concatenate([self.times, time])
        self.good = np.concatenate([self.good, good])
        for word, fine in zip(words, good.tolist()):
            self.index[word] = len(self.texts)
            self.texts.append(next(texts) if fine else "")
            self.chars += len(word)

    def _pair_ids(self, codes: np.ndarray) -> np.ndarray:
        """A number for every code, counted from 0 as they first come."""
        distinct, at = np.unique(codes, return_inverse=True)
        known = self.pair_ids
        ids = np.array([known.setdefault(c, len(known)) for c in distinct.tolist()], np.int64)
        new = ids >= len(self.codes)
        self.codes = np.concatenate([self.codes, distinct[new][np.argsort(ids[new])]])
        return ids[at] if len(ids) else ids

    def documents(self, texts: list[str]) -> dict[str, list]:
        """The columns of whole texts of one range each; an empty text has no tokens."""
        words = [_WORD.findall(" " + t) if t else [] for t in texts]
        if len(self.index) > WORDS or self.chars > WORD_CHARS:
            self.forget()
        fresh = [w for w in set(itertools.chain.from_iterable(words)) if w not in self.index]
        if fresh:
            self.learn(sorted(fresh))
        sizes = np.array([len(w) for w in words], np.int64)
        at = np.array(list(map(self.index.__getitem__, itertools.chain.from_iterable(words))), np.int64)
        doc = np.repeat(np.arange(len(texts)), sizes)
        bad = np.zeros(len(texts), bool)
        bad[doc[~self.good[at]]] = True

        def total(values: np.ndarray) -> np.ndarray:
            ends = np.concatenate([[0], np.cumsum(values[at])])[np.concatenate([[0], np.cumsum(sizes)])]
            return np.where(bad, 0, np.diff(ends))

        until = [0, *np.cumsum(sizes).tolist()]
        numbers = at.tolist()
        hashes = [hashlib.sha256(";".join(map(self.texts.__getitem__, numbers[until[d] : until[d + 1]])).encode()).hexdigest() if sizes[d] and not bad[d] else "" for d in range(len(texts))]
        keep = ~bad[doc]
        key, times = np.unique((doc[keep] << 32) | at[keep], return_counts=True)
        word = key & 0xFFFFFFFF
        each = self.n_pairs[word]
        place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(self.first[word], each)
        key, times = _summed((np.repeat(key >> 32, each) << 32) | self.pairs[place], np.repeat(times, each) * self.times[place])
        offsets = np.searchsorted(key >> 32, np.arange(len(texts) + 1)).astype(np.int32)
        return {
            "n_a": total(self.n_a), "n_b": total(self.n_b), "n_groups": total(self.n_groups), "n_links": total(self.n_links), "groups_sha256": hashes,
            "pairs": pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.codes[key & 0xFFFFFFFF] if len(key) else key)),
            "times": pa.ListArray.from_arrays(pa.array(offsets), pa.array(times)),
        }


@functools.lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


COUNTS = "n_a long, n_b long, n_groups long, n_links long"
LINKED = "pairs array<long>, times array<long>"
LEAF = f"row long, doc_id long, {COUNTS}, groups_sha256 string, {LINKED}, n long, a_at long, a_text string, b_at long, b_text string"
OPEN = ", ".join(f"{side}_{part} array<long>" for side in ("head", "tail") for part in ("a", "a_ends", "b", "b_ends"))
#: ``at`` is the byte at which the first closed group of a row ends.
CLOSED = f"at long, groups string, n_groups long, n_links long, {LINKED}"
FRAGMENT = f"row long, n long, n_a long, n_b long, same boolean, cut boolean, {OPEN}, {CLOSED}"


def _batch(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _closed(run: Tokens) -> dict:
    if not len(run.a):
        return {}
    groups = Groups.of(run)
    codes, times = _summed(groups.codes, groups.times)
    return {"at": int(groups.ends[0]), "groups": ";".join(groups.texts), "n_groups": len(groups.ends), "n_links": int((groups.n_a * groups.n_b).sum()), "pairs": codes, "times": times}


def _opened(f: Fragment) -> dict:
    out = {"cut": f.tail is not None}
    for side, t in (("head", f.head), ("tail", f.tail or NONE)):
        out |= {f"{side}_{name}": x for name, x in zip(("a", "a_ends", "b", "b_ends"), t.parts())}
    return out


def _fragment(row: dict) -> Fragment:
    head, tail = (tokens(*(row[f"{side}_{x}"] for x in ("a", "a_ends", "b", "b_ends"))) for side in ("head", "tail"))
    return Fragment(head, NONE, tail if row["cut"] else None)


def _leaves(df: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """Short texts with their columns, and the ranges of long ones."""
    schema = _arrow_schema(df.sparkSession, LEAF)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in (part for whole in batches for part in slices(whole)):
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            short = [i for i, t in enumerate(texts) if len(t) < RANGE_CHARS]
            if short:
                part = batch.take(pa.array(short, pa.int64()))
                columns = {"row": part.column("row"), "doc_id": part.column("doc_id")} | aligner.documents([texts[i] for i in short])
                yield pa.record_batch([pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) if f.name in columns else pa.nulls(len(short), f.type) for f in schema], schema=schema)
            for i in sorted({*range(len(texts))} - {*short}):
                yield from ranges(batch.column("row")[i].as_py(), batch.column("doc_id")[i].as_py(), " " + texts[i], aligner)

    def ranges(row: int, doc_id: int | None, text: str, aligner: Aligner) -> Iterator[pa.RecordBatch]:
        a = b = a_at = b_at = 0
        for n, (next_a, next_b) in enumerate([*aligner.cuts(text), (len(text), len(text))]):
            a_text, b_text = text[a:next_a], text[b:next_b]
            # mostly A and B are cut at the same place
            yield _batch(schema, [{"row": row, "doc_id": doc_id, "n": n, "a_at": a_at, "a_text": a_text, "b_at": b_at, "b_text": None if (a, next_a) == (b, next_b) else b_text}])
            a, b, a_at, b_at = next_a, next_b, a_at + len(a_text.encode()), b_at + len(b_text.encode())

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return stage(rows.mapInArrow(run, LEAF), "aligned")


def _range_fragments(ranges: DataFrame, path_a: str, path_b: str) -> DataFrame:
    schema = _arrow_schema(ranges.sparkSession, FRAGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for r in (row for batch in batches for row in _rows(batch)):
            b_text = r["a_text"] if r["b_text"] is None else r["b_text"]
            whole, same = aligner.range_tokens(r["a_text"], r["a_at"], b_text, r["b_at"])
            f = Fragment.of(whole)
            yield _batch(schema, [{"row": r["row"], "n": r["n"], "n_a": len(whole.a), "n_b": len(whole.b), "same": same} | _opened(f) | _closed(f.closed)])

    dealt = ranges.select("row", "n", "a_at", "a_text", "b_at", "b_text").repartition("row", "n")
    return stage(dealt.mapInArrow(run, FRAGMENT), "fragments")


def _composed(fragments: DataFrame, last: bool) -> DataFrame:
    """Every FAN neighbours as one fragment, and the groups closed by that; in the last round the first group of every text too."""
    schema = _arrow_schema(fragments.sparkSession, FRAGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, Fragment()

        def finished() -> pa.RecordBatch:
            if last:
                return _batch(schema, [{"row": key[0]} | _closed(held.whole())])
            return _batch(schema, [{"row": key[0], "n": key[1]} | _opened(held)])

        for r in (row for batch in batches for row in _rows(batch)):
            if key != (r["row"], r["n"] // FAN):
                if key is not None:
                    yield finished()
                key, held = (r["row"], r["n"] // FAN), Fragment()
            held = held + _fragment(r)
            if len(held.closed.a):
                yield _batch(schema, [{"row": key[0]} | _closed(held.closed)])
                held = Fragment(held.head, NONE, held.tail)
        if key is not None:
            yield finished()

    near = fragments.withColumn("m", F.expr(f"n DIV {FAN}")).repartition("row", "m").sortWithinPartitions("row", "n").drop("m")
    return stage(near.mapInArrow(run, FRAGMENT), "composed")


def _hashes(closed: DataFrame) -> DataFrame:
    """row, groups_sha256: closed groups in the order of the text go through the hash one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, state = None, None
        for r in (row for batch in batches for row in _rows(batch)):
            if r["row"] != row:
                if row is not None:
                    yield pa.record_batch([pa.array([row], pa.int64()), pa.array([state.hexdigest()])], names=["row", "groups_sha256"])
                row, state = r["row"], hashlib.sha256(r["groups"].encode())
            else:
                state.update(b";" + r["groups"].encode())
        if row is not None:
            yield pa.record_batch([pa.array([row], pa.int64()), pa.array([state.hexdigest()])], names=["row", "groups_sha256"])

    ordered = closed.select("row", "at", "groups").repartition("row").sortWithinPartitions("row", "at")
    return ordered.mapInArrow(run, "row long, groups_sha256 string")


def _long_texts(ranges: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """row, COUNTS, groups_sha256 of the texts of several ranges, and their linked pairs: row, pair, times."""
    level = _range_fragments(ranges, path_a, path_b)
    of_range = level
    good = of_range.groupBy("row").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.bool_and("same").alias("same"))
    good = stage(good.where("same").drop("same"), "whole")
    level = level.join(good.select("row"), "row", "left_semi")
    open_names = ["row", "n", "cut", *(f.split()[0] for f in OPEN.split(", "))]
    closed_names = ["row", *(f.split()[0] for f in CLOSED.split(", "))]
    closed = level.where("at IS NOT NULL").select(closed_names)
    left = (level.agg(F.max("n")).first()[0] or 0) + 1
    while left:
        left = 0 if left <= FAN else -(-left // FAN)
        level = _composed(level.where("n IS NOT NULL").select(open_names), last=not left)
        closed = closed.unionByName(level.where("at IS NOT NULL").select(closed_names))
    sums = closed.groupBy("row").agg(F.sum("n_groups").alias("n_groups"), F.sum("n_links").alias("n_links"))
    pairs = closed.select("row", F.inline(F.arrays_zip("pairs", "times"))).groupBy("row", F.col("pairs").alias("pair")).agg(F.sum("times").alias("times"))
    return good.join(sums, "row").join(_hashes(closed), "row"), stage(pairs, "long-pairs")


def align(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (row, doc_id, COUNTS, groups_sha256), their linked pairs (row, pair, times) and the counts of the pairs
    (pair, a, b, documents, best: whether no other pair of ``a`` stands in more documents)."""
    leaves = _leaves(df, id_col, text_col, path_a, path_b)
    names = [f.split()[0] for f in COUNTS.split(", ")]
    rows = leaves.where("n IS NULL").select("row", "doc_id", *names, "groups_sha256")
    pairs = leaves.where("n IS NULL").select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    ranges = leaves.where("n IS NOT NULL")
    if not ranges.isEmpty():
        found, long_pairs = _long_texts(ranges, path_a, path_b)
        long_rows = ranges.where("n = 0").select("row", "doc_id").join(found, "row", "left")
        long_rows = long_rows.select("row", "doc_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in names), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
        rows, pairs = rows.unionByName(long_rows), pairs.unionByName(long_pairs)
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    counts = stage(pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("documents")).select("pair", a.alias("a"), b.alias("b"), "documents"), "pair-counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    counts = counts.join(most, "a").select("pair", "a", "b", "documents", (F.col("documents") == F.col("most")).alias("best"))
    return rows, pairs, stage(counts, "pair-counts")


def token_alignment(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, COUNTS, n_best, count_sum and groups_sha256 of every row."""
    rows, pairs, counts = align(df, path_a, path_b, id_col, text_col)
    total = counts.agg(F.sum("documents")).first()[0] or 0
    # Counts add up to the total, so at most COMMON_PAIRS of them reach this; the others are joined by a shuffle.
    often = max(2, -(-total // COMMON_PAIRS))
    value = counts.select("pair", "documents", "best")
    met = pairs.join(F.broadcast(value.where(F.col("documents") >= often)), "pair", "left")
    rare = met.where("documents IS NULL").select("row", "pair", "times").join(value.where(F.col("documents") < often), "pair")
    n_best, count_sum = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)), F.sum(F.col("times") * F.col("documents"))
    scored = met.where("documents IS NOT NULL").unionByName(rare).groupBy("row").agg(n_best.alias("n_best"), count_sum.alias("count_sum"))
    names = [f.split()[0] for f in COUNTS.split(", ")]
    return rows.join(scored, "row", "left").select("doc_id", *names, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
