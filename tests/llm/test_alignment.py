import hashlib
import json
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ebbline.llm import alignment as al
from ebbline.llm import queries

PATHS = public_tokenizers.path(al.VOCABULARY_A), public_tokenizers.path(al.VOCABULARY_B)
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
with open(PATHS[0], encoding="utf-8") as file:
    ENTRIES = {i: e for e, i in json.load(file)["model"]["vocab"].items()}
#: The bytes that a byte-level vocabulary writes as themselves.
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
DECODE = {chr(b): b for b in PLAIN} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*PLAIN}))}


def brute_groups(text):
    """Whole text, token by token."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    bytes_a = [bytes(DECODE[c] for c in ENTRIES.get(i, "")) for i in a]
    bytes_b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    groups, i, j = [], 0, 0
    for end in sorted({*ends_a} & {*ends_b}):
        x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return groups


def brute(rows):
    found = [brute_groups(t) for _, t in rows]
    links = [Counter((a, b) for g in groups or [] for a in g[0] for b in g[1]) for groups in found]
    counts = Counter(pair for one in links for pair in one)
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _), groups, linked in zip(rows, found, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups or [])
        out.append((
            i, sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(groups or []), sum(linked.values()),
            sum(n for p, n in linked.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in linked.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str)


TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "the  quick   brown\n\n fox\tjumps ", "", None, " leading space", "\nline feed first\r\nand more\r\n", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "▁ is a space to one of them", "naïve café — “quoted” … ﬁne", "日本語のテキスト、これは長い。漢字", "😀😃 emoji👩‍👩‍👧 joined", "x" * 500, "don't can't we'll I've", "a b c　d\x85e\x1cf\x0bg", "\x00\x01\x02", "tab\tand  ;\r next(\r\n)", "1234567890 3.14159 -- ==== ((()))",
    "The quick brown fox jumps over the lazy dog.", "   ", "\n", "é́é Å", "http://example.com/a?b=c&d=e#f", "{\r \"a\": [1, 2]}\r\r\n",
]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "same id"), (3, "same id")]


def test_rows_equal_brute_force(spark, documents):
    df = documents(ROWS).withColumnRenamed("lang", "row").withColumnRenamed("source", "pair").withColumnRenamed("n_chars", "a.b")
    assert found(al.token_alignment(df, *PATHS)) == brute(ROWS)
    assert found(al.token_alignment(documents([]), *PATHS)) == []


@pytest.mark.parametrize("chars", [1, 6, 23])
def test_ranges_of_long_texts(spark, documents, monkeypatch, chars):
    monkeypatch.setattr(al, "RANGE_CHARS", chars)
    monkeypatch.setattr(al, "FAN", 3)
    monkeypatch.setattr(al, "COMMON_PAIRS", 10)  # most pairs are joined by a shuffle
    assert found(al.token_alignment(documents(ROWS), *PATHS)) == brute(ROWS)


def test_words_are_forgotten_without_loss(spark, documents, monkeypatch):
    monkeypatch.setattr(al, "WORDS", 5)
    monkeypatch.setattr(al, "AT_ONCE", 6)
    monkeypatch.setattr(al, "JOINED", 3)
    aligner = al.Aligner(*PATHS)
    texts = [t or "" for t in TEXTS]
    once = [aligner.documents([t]) for t in texts for _ in range(2)][::2]
    for t, one in zip(texts, once):
        groups = brute_groups(t) or []
        assert one["n_groups"].tolist() == [len(groups)] and one["n_links"].tolist() == [sum(len(a) * len(b) for a, b in groups)]


def test_a_large_group_is_counted_by_its_distinct_ids(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(1, 5, 90).tolist(), rng.integers(0, 4, 70).tolist()
    g = al.tokens(a, np.arange(90) * 2 + 1, b, [*range(0, 138, 2), 179])
    want = Counter((x << 32) | y for x in a for y in b)
    for large in (10, 10_000):
        monkeypatch.setattr(al, "LARGE", large)
        groups = al.Groups.of(g)
        codes, times = al._summed(groups.codes, groups.times)
        assert dict(zip(codes.tolist(), times.tolist())) == want and groups.ends.tolist() == [179]


sides = st.lists(st.integers(1, 4), max_size=30)


def streams(a, b):
    """Tokens of both sides; their ids are their numbers."""
    return al.tokens(range(len(a)), np.cumsum(a), range(len(b)), np.cumsum(b))


def as_lists(f):
    one = lambda t: None if t is None else [x.tolist() for x in t.parts()]
    return one(f.head), one(f.closed), one(f.tail)


@settings(max_examples=300, deadline=None)
@given(sides, sides, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=5), st.randoms())
def test_fragments_are_a_monoid(a, b, cuts, random):
    """Any cuts of A and B, different ones, and any order of composition give the fragment of the whole."""
    whole = streams(a, b)
    i, j = (sorted(min(c[k], n) for c in cuts) for k, n in ((0, len(a)), (1, len(b))))
    i, j = [0, *i, len(a)], [0, *j, len(b)]
    parts = [al.Fragment.of(al.Tokens(whole.a[i[k] : i[k + 1]], whole.a_ends[i[k] : i[k + 1]], whole.b[j[k] : j[k + 1]], whole.b_ends[j[k] : j[k + 1]])) for k in range(len(i) - 1)]
    want = as_lists(al.Fragment.of(whole))
    assert as_lists(reduce(lambda x, y: x + y, parts, al.Fragment())) == want
    while len(parts) > 1:
        k = random.randrange(len(parts) - 1)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    assert as_lists(parts[0] + al.Fragment()) == want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\t\r.,'’éßж日。😀▁1= "), max_size=60))
def test_words_and_ranges_give_whole_encodings(text):
    aligner = _ALIGNER
    one = aligner.documents([text])
    groups = brute_groups(text) or []
    assert one["n_a"].tolist() == [sum(len(a) for a, _ in groups)] and one["n_b"].tolist() == [sum(len(b) for _, b in groups)] and one["n_groups"].tolist() == [len(groups)]


_ALIGNER = al.Aligner(*PATHS)


def test_query(spark, sf_dir):
    got = found(queries.QUERIES["op11_token_alignment"](spark, sf_dir))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got == brute(rows)
