"""Quality rules as a ledger of failure bits and measurements, judged by versioned policies.

``ledger`` measures a text once and evaluates every rule of RULES once: bit r of ``fail_bits`` is set if rule r
fails. A policy is a mask of the rules that reject; applying, changing or comparing policies needs the ledger only.
``ablations`` answers, by bitwise aggregation over the distinct bit patterns, how many documents a policy
rejects, and how many it would keep again if one rule were taken out.

Words are maximal runs without ASCII white space (space, tab to carriage return); lines are cut at line feeds; characters
are code points. A null or empty text has no words, fails the length rule and is not kept. Rows are independent: repeated
rows and null ids stay as they are; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ebbline.llm.common import map_batches, texts_of

SYMBOLS = b"#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` (SQL over the measurements) is true."""

    name: str
    fails: str


#: The position of a rule is its bit. Append only: stored ledgers and policies refer to positions.
RULES: tuple[Rule, ...] = (
    Rule("too_few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("too_many_words", "n_words > 1000000"),
    Rule("mean_word_short", "word_chars < 2 * n_words"),
    Rule("mean_word_long", "word_chars > 20 * n_words"),
    Rule("symbol_words", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 5 * n_lines"),
    Rule("some_repeats", "100 * n_repeat_words > 10 * n_words"),
)


def bits(*names: str) -> int:
    """The mask of the named rules."""
    position = {rule.name: i for i, rule in enumerate(RULES)}
    return sum(1 << position[name] for name in set(names))


@dataclass(frozen=True)
class Policy:
    version: str
    mask: int


BASE = Policy("base", bits("too_few_words", "repeated_windows"))
#: Version 1 rejects what hardly is prose; the other rules are measured and stored only.
V1 = Policy("v1", BASE.mask | bits("too_many_words", "mean_word_short", "mean_word_long", "symbol_words", "duplicate_lines"))
V2 = Policy("v2", V1.mask | bits("some_repeats"))
POLICIES = (BASE, V1, V2)


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text, overlapping ones included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    # Rank doubling: equal ranks mean equal runs of 1, 2, 4, ... words, so the answer has no collisions.
    ranks, length = ids, 1
    while length < window:
        step = min(length, window - length)
        pairs = ranks[: len(ranks) - step] * len(words) + ranks[step:]
        _, ranks, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        length += step
        if len(counts) == len(ranks):
            return 0  # no run of this length occurs twice, so no longer one does
    starts = np.flatnonzero(counts[ranks] > 1)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(marks[:-1])))


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()
    seen: set[bytes] = set()
    n_lines = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            n_lines += 1
            seen.add(line)
    chars = len(b"".join(words).decode("utf-8", "replace"))
    return len(words), chars, sum(text.count(s) for s in SYMBOLS), n_lines, n_lines - len(seen), repeated_words(words)


def fail_bits(rules: Sequence[Rule] = RULES) -> Column:
    """All rules in one expression."""
    return sum((F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(rules)), F.lit(0).cast("long"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``id_col``, the measurements and ``fail_bits`` of every row."""

    def make(batch):
        columns = list(zip(*map(measure, texts_of(batch, "_text"))))
        return {"_id": batch.column("_id")} | dict(zip(MEASURES, columns))

    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    out = map_batches(rows, make, "_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    return out.select(F.col("_id").alias(id_col), *MEASURES, fail_bits(rules).alias("fail_bits"))


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """Add ``rejecting_bits``, ``kept`` and ``policy``. ``sole_rule``: the rule that alone rejects the row, else null."""
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    sole = F.when(F.bit_count(hit) == 1, F.element_at(F.array(*(F.lit(r.name) for r in RULES)), F.length(F.regexp_replace(F.bin(hit), "^0+", ""))))
    return entries.withColumns({"rejecting_bits": hit, "kept": hit == 0, "sole_rule": sole, "policy": F.lit(policy.version)})


def ablations(entries: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per policy and rule of it: documents, rejected, failing the rule, and kept again without it.

    Documents are first counted per bit pattern (at most 2^rules rows whatever the input), so the ledger is
    shuffled as a few partial counts. An empty ledger gives no rows.
    """
    patterns = entries.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    pairs = [(p.version, p.mask, r.name, 1 << i) for p in policies for i, r in enumerate(rules) if p.mask >> i & 1]
    cases = F.explode(F.array(*(F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask"), F.lit(name).alias("rule"), F.lit(b).cast("long").alias("bit")) for v, m, name, b in pairs)))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return (
        patterns.select("fail_bits", "n", cases.alias("c")).select("fail_bits", "n", "c.*")
        .groupBy("policy", "rule")
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("rejected"),
            F.sum(F.when(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failing"),
            F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("kept_without"),
        )
    )
