"""Information-theoretic sanitisation of personal data.

Protected entities are the e-mail addresses, IP addresses, card and phone numbers found by fixed patterns. A term (a run
of at least MIN_LETTERS letters, lower-cased) near an entity may disclose it. How strongly is estimated from the whole corpus: with n documents,
n(e) that hold entity e, n(t) that hold term t anywhere and n(e,t) that hold t within REACH characters of e,

    PMI(e; t) = log2(n * n(e,t) / (n(e) * n(t)))      IC(e) = log2(n / n(e))      disclosure = PMI / IC <= 1.

A disclosure of 1 means that whoever sees the term knows the entity. A pair that meets in fewer than ``support`` documents may meet by chance: there
the share n(e,t) / n(t) in the PMI is drawn to that of the whole corpus by ``support`` documents more of the term, s: (n(e,t) + s * n(e) / n) / (n(t) + s). So
a term that stands nowhere but next to an entity of a single document loses two bits (it is generalised in a corpus of a hundred documents, removed in one of
a million), and a common word discloses nothing. A term
is removed from the entity's neighbourhood if its disclosure is at least REMOVE, and generalised to its class if it is at least
GENERALISE. All pairs are rated. An entity that all documents hold carries no information (IC 0) and discloses nothing.

Spans are kind:start:end in code points, end exclusive, by start and then kind in the order of KINDS. Base kinds match leftmost,
without overlaps within a kind; matches that fail their check are dropped and not tried again. A null or empty text has no
spans. Rows are independent but for the statistics, in which repeated rows count as often as they occur; null ids are
kept. Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbline.llm.common import map_batches, quoted, slices, unused
from ebbline.session import stage

KINDS = ("email", "ip", "card", "phone", "removed", "general")
BASE_KINDS = KINDS[:4]
#: Characters on either side of an entity in which a term is near it.
REACH = 60
#: Documents a pair must meet in to be rated by its bare counts.
SUPPORT = 3
REMOVE, GENERALISE = 0.9, 0.7
MIN_LETTERS = 3

# Fixed patterns. Possessive repeats and the look-behind change no match; they keep long runs linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9][\x20.0-9-]*+")
TERM = re.compile(r"[^\W\d_]{%d,}" % MIN_LETTERS)
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The sign @ is in no other part of the pattern, so a match surrounds one: back to the start of the run before
    it, or to the end of the match before."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """kind, start, end and the entity in a normal form."""
    found = [("email", s, e, text[s:e].lower()) for s, e in emails(text)]
    for run in DIGITS.finditer(text):
        s, e = run.span()
        if e - s < 7:
            continue
        for m in IP.finditer(text, s, e):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append(("ip", *m.span(), ".".join(p or "0" for p in parts)))
        for m in CARD.finditer(text, s, e):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span(), digits))
    if "+" in text:
        for m in PHONE.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if 9 <= len(digits) <= 15:
                found.append(("phone", *m.span(), digits))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return found


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def contexts(text: str, spans: list[tuple[str, int, int, str]], reach: int = REACH) -> list[dict]:
    """Entity, term, start and end of every whole term within ``reach`` characters of an entity, outside all spans."""
    merged: list[list[int]] = []
    for _, start, end, _ in spans:  # by start
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    starts = [m[0] for m in merged]
    out = []
    for kind, start, end, entity in spans:
        for low, high in ((max(0, start - reach), start), (end, min(len(text), end + reach))):
            for m in TERM.finditer(text, low, high):
                s, e = m.span()
                cut = s == low and s and text[s - 1].isalpha() or e == high and e < len(text) and text[e].isalpha()
                at = bisect.bisect_left(starts, e) - 1  # the last span that begins before the term ends
                if not cut and (at < 0 or merged[at][1] <= s):
                    out.append({"entity": f"{kind}:{entity}", "term": m[0].lower(), "start": s, "end": e})
    return out


CONTEXT = "array<struct<entity: string, term: string, start: int, end: int>>"


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """The stored base result: row (a number of the row), doc_id, text_hash, counts, base spans, distinct entities and contexts."""
    schema = "row long, doc_id long, text_hash long, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, entities array<string>, contexts " + CONTEXT

    def make(batch):
        out: dict[str, list] = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256", "entities", "contexts")}
        for text in batch.column("_text").to_pylist():
            spans = base_spans(text) if text else []
            kinds = Counter(s[0] for s in spans)
            for kind in BASE_KINDS:
                out[f"n_{kind}"].append(kinds[kind])
            base = joined([s[:3] for s in spans])
            out["base"].append(base)
            out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            out["entities"].append(sorted({f"{kind}:{entity}" for kind, _, _, entity in spans}))
            out["contexts"].append(contexts(text, spans, reach) if spans else [])
        return {"row": batch.column("_row"), "doc_id": batch.column("_id"), "text_hash": batch.column("_hash")} | out

    text = F.col(text_col).cast("string")
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_hash"))
    return stage(map_batches(rows, make, schema), "privacy-base")


def term_documents(df: DataFrame, text_col: str = "text") -> DataFrame:
    """term and n: documents with the term, as counts per batch of rows that are still to be added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for part in slices(batch):
                for text in part.column("_text").to_pylist():
                    if text:
                        counts.update(set(TERM.findall(text.lower())))
            yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return df.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(count, "term string, n long")


def disclosures(df: DataFrame, found: DataFrame, text_col: str = "text", support: int = SUPPORT, remove: float = REMOVE, generalise: float = GENERALISE) -> DataFrame:
    """entity, term, disclosure and kind ("removed" or "general") of the pairs above the thresholds."""
    spots = found.select("row", F.explode("contexts").alias("c")).select("row", "c.entity", "c.term").distinct()
    pairs = stage(spots.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")), "privacy-pairs")
    # The documents of an entity are all that hold it, also those where no term is near it.
    holders = found.select(F.explode("entities").alias("entity"))
    entities = holders.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    terms = stage(pairs.select("term").distinct(), "privacy-terms")
    # Only terms of a pair need a count; if they are few, Catalyst broadcasts them and the others are never shuffled.
    counted = term_documents(df, text_col).join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n_term"))
    n = found.count()
    both = pairs.join(entities, "entity").join(counted, "term").where(F.col("n_entity") < n)
    bits = lambda top, below: F.log2(top / below)
    met, of_term, of_entity = F.col("n_both").cast("double"), F.col("n_term").cast("double"), F.col("n_entity").cast("double")
    rare = F.when(F.col("n_both") < support, F.lit(float(support))).otherwise(F.lit(0.0))
    score = bits(F.lit(float(n)) * (met + rare * of_entity / n), of_entity * (of_term + rare)) / bits(F.lit(float(n)), of_entity)
    rated = both.withColumn("disclosure", score).where(F.col("disclosure") >= generalise)
    return rated.select("entity", "term", "disclosure", F.when(F.col("disclosure") >= remove, "removed").otherwise("general").alias("kind"))


def private_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """doc_id, text_hash, counts of the base kinds, base_sha256, spans (base and disclosing terms) and n_terms of every row."""
    found = find(df, id_col, text_col)
    told = stage(disclosures(df, found, text_col, **thresholds), "privacy-disclosures")
    spots = found.select("row", F.explode("contexts").alias("c")).select("row", "c.*")
    # A term next to several entities is removed if it discloses any of them that far.
    hits = spots.join(told, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("kind").alias("kind"))
    added = hits.groupBy("row").agg(F.collect_list(F.struct(F.col("start").alias("s"), F.when(F.col("kind") == "removed", 4).otherwise(5).alias("k"), F.col("end").alias("e"), "kind")).alias("added"))
    rows = found.join(added, "row", "left")
    base = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), _parsed)
    spans = F.array_sort(F.concat(base, F.coalesce("added", F.array().cast("array<struct<s:int,k:int,e:int,kind:string>>"))))
    text = F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    return rows.select("doc_id", "text_hash", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", text.alias("spans"), F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_terms"))


def _parsed(span):
    parts = F.split(span, ":")
    order = F.array_position(F.array(*(F.lit(k) for k in KINDS)), parts[0]) - 1
    return F.struct(parts[1].cast("int").alias("s"), order.cast("int").alias("k"), parts[2].cast("int").alias("e"), parts[0].alias("kind"))


def redact(text: str | None, spans: str) -> str | None:
    """The text without its spans: base spans become their kind, general terms their class, removed terms vanish. Where
    spans overlap, the one that begins first stands for both."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, start, end in (x.split(":") for x in spans.split(",")):
        s, e = int(start), int(end)
        if s >= at:
            out.append(text[at:s])
            if kind == "general":
                out.append("[NAME]" if text[s].isupper() else "[WORD]")
            elif kind != "removed":
                out.append(f"[{kind.upper()}]")
        at = max(at, e)
    return "".join(out) + text[at:]


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``df`` with the texts redacted. A row meets its spans again by its id and a hash of its text."""
    spans = private_spans(df, id_col, text_col, **thresholds).where("spans <> ''").dropDuplicates(["doc_id", "text_hash"])
    d, t, marked = unused(df, "_d", "_t", "_spans")
    spans = spans.select(F.col("doc_id").alias(d), F.col("text_hash").alias(t), F.col("spans").alias(marked))
    text = F.col(text_col).cast("string")
    rows = df.join(spans, F.col(id_col).cast("long").eqNullSafe(F.col(d)) & (F.xxhash64(text) == F.col(t)), "left")

    @F.pandas_udf("string")
    def redacted(texts: pd.Series, marks: pd.Series) -> pd.Series:
        return pd.Series([redact(t, m) for t, m in zip(texts, marks)], dtype=object)

    new = F.when(F.col(marked).isNull(), text).otherwise(redacted(text, F.col(marked)))
    return rows.withColumn(text_col, new).select(*quoted(df))
