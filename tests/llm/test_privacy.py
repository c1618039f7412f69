import hashlib
import math
import random
import re

from hypothesis import given, settings, strategies as st

from ebbline.llm import privacy as p
from ebbline.llm.queries import op1_privacy

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        odd, even = digits[-1::-2], digits[-2::-2]
        return 12 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), k, m.end()) for k, kind in enumerate(PATTERNS) for m in re.finditer(PATTERNS[kind], text) if passes(kind, m[0])]
    return ",".join(f"{p.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


PIECES = ["a.b@c.de", "x@y", "@", "@@a.b", "1.2.3.4", "256.1.1.1", "0001.002.3.255", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "+49 (30) 123-4567", "+1", "+12345678901234567", " ", "-", ".", "é", "word", "\n", "9", "+"]


@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
@settings(max_examples=500, deadline=None)
def test_base_spans_equal_the_patterns(text):
    assert p.joined([s[:3] for s in p.base_spans(text)]) == brute(text)


def test_long_texts_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1(" * 100_000, "@" * 300_000, "a@b." * 80_000, "a@b.cc " * 20_000):
        spans = p.base_spans(text)
        p.contexts(text, spans)
        assert len(spans) == (20_000 if text.startswith("a@b.cc") else len(spans))


def reference(rows):
    """Spans of every row by the definition."""
    base = [p.base_spans(t or "") for _, t in rows]
    near = [p.contexts(t or "", b) for (_, t), b in zip(rows, base)]
    terms = [set(p.TERM.findall((t or "").lower())) for _, t in rows]
    n, out = len(rows), []
    for (doc_id, text), spans, spots in zip(rows, base, near):
        kinds = {}
        for c in spots:
            both = sum(any(x["entity"] == c["entity"] and x["term"] == c["term"] for x in o) for o in near)
            holds = sum(any(f"{kind}:{entity}" == c["entity"] for kind, _, _, entity in b) for b in base)
            n_term = sum(c["term"] in t for t in terms)
            if holds < n:
                share = both / n_term if both >= p.SUPPORT else (both + p.SUPPORT * holds / n) / (n_term + p.SUPPORT)
                told = math.log2(share / (holds / n)) / math.log2(n / holds)
                if told >= p.GENERALISE:
                    key = (c["start"], c["end"])
                    kinds[key] = max(kinds.get(key, ""), "removed" if told >= p.REMOVE else "general")
        out.append((doc_id, p.joined([s[:3] for s in spans] + [(k, s, e) for (s, e), k in kinds.items()])))
    return out


def corpus():
    random.seed(5)
    common = ["about", "people", "water", "house", "light", "never"]
    rows = [(i, " ".join(random.choices(common, k=12))) for i in range(40)]
    rows += [(100 + i, f"Please ask Zarathustra {random.choice(common)} at zara{i % 2}@mail.example.com today {random.choice(common)}") for i in range(10)]
    rows += [(200, "Zarathustra alone"), (201, None), (202, ""), (203, "call +49 30 1234567 or 4111 1111 1111 1111"), (None, "ask Zarathustra zara1@mail.example.com"), (100, rows[40][1])]
    return rows


def test_query_equals_the_definition(spark, documents, save):
    rows = corpus()
    got = op1_privacy(spark, save(documents=documents(rows).withColumnRenamed("lang", "spans"))).collect()
    key = lambda x: (x[0] is None, x)
    assert sorted(((r.doc_id, r.spans) for r in got), key=key) == sorted(reference(rows), key=key)
    assert any("removed" in r.spans or "general" in r.spans for r in got)
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        assert r.base_sha256 == hashlib.sha256(brute(text).encode()).hexdigest()
        assert r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_terms == len([x for x in r.spans.split(",") if x])
        if not brute(text):
            assert r.spans == ""


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op1_privacy(spark, sf_dir).collect():
        assert r.base_sha256 == hashlib.sha256(brute(texts[r.doc_id]).encode()).hexdigest()


def test_sanitise(spark, documents):
    rows = corpus()
    got = {r.doc_id: r.text for r in p.sanitise(documents(rows)).collect()}
    assert got[0] == rows[0][1] and got[201] is None
    assert got[203] == "call [PHONE] or [CARD]"
    assert "@" not in got[104] and "[EMAIL]" in got[104]
    assert p.sanitise(documents([])).count() == 0 and p.private_spans(documents([])).count() == 0
    assert p.redact("Call Bob Now 1", "general:5:8,removed:9:12") == "Call [NAME]  1"


def test_entities_count_in_documents_without_terms_near(spark, documents):
    text = "Please ask Zarathustra at zara@mail.example.com today"
    rows = [(i, text) for i in range(4)] + [(10 + i, f"{i} | zara@mail.example.com | {i}") for i in range(12)] + [(50 + i, "nothing here") for i in range(16)]
    found = p.find(documents(rows))
    told = {r.term: r.disclosure for r in p.disclosures(documents(rows), found, generalise=-9.0).collect()}
    # 32 documents, 16 hold the entity, 4 the term, all 4 near the entity
    assert math.isclose(told["zarathustra"], math.log2(32 * 4 / (16 * 4)) / math.log2(32 / 16))
    mixed = rows + [(70 + i, "Zarathustra alone") for i in range(1)]
    # PMI log2(33 * 4 / (16 * 5)) over IC log2(33 / 16); from the 4 documents with a term near it would be 0.89
    got = {r.term: r.disclosure for r in p.disclosures(documents(mixed), p.find(documents(mixed)), generalise=-9.0).collect()}
    assert math.isclose(got["zarathustra"], math.log2(33 * 4 / (16 * 5)) / math.log2(33 / 16))


def test_pairs_of_rare_entities(spark, documents):
    """An entity of a single document: the name and a rare word near it are rated, a word of more documents and common ones stay."""
    rows = [(i, "people ask about water and light") for i in range(4000)] + [(5000 + i, "the harbour keeps its boats") for i in range(20)]
    rows += [(9000, "people ask Quintessa of the harbour: quin@mail.example.com")]
    text = rows[-1][1]

    def named(rows, **thresholds):
        got = {r.doc_id: r for r in p.private_spans(documents(rows), **thresholds).collect()}
        assert all(not r.spans for i, r in got.items() if i != 9000)
        spans = [x.split(":") for x in got[9000].spans.split(",")]
        assert got[9000].n_terms == len(spans) - 1
        return {(kind, text[int(s) : int(e)]) for kind, s, e in spans} - {("email", "quin@mail.example.com")}

    assert named(rows) == {("general", "Quintessa")}
    few = [r for r in rows if not 5003 <= r[0] < 9000]  # "the" and "harbour" in four documents
    assert named(few) == {("general", "Quintessa"), ("general", "the"), ("general", "harbour")}
    assert named(few, remove=0.8) == {("removed", "Quintessa"), ("general", "the"), ("general", "harbour")}
