"""Registered queries of the operators and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ebbline.llm import alignment, decontamination, files, fingerprints, hard_negatives, mixing, near_duplicates, privacy, quality, repeated_passages, token_counts, token_files, toxicity, warc
from ebbline.llm.common import read_table
from ebbline.session import stage


def op1_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.private_spans(read_table(spark, sf_dir, "documents")).drop("text_hash")


def op2_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = files.new_folder(spark, "warc")
    manifest = warc.write_warc(read_table(spark, sf_dir, "pages"), folder)
    return warc.read_warc(manifest, folder).drop("url")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.ledger(read_table(spark, sf_dir, "documents"))
    base = entries["fail_bits"].bitwiseAND(quality.BASE.mask) != 0
    judged = quality.apply_policy(entries.withColumn("base_failed", base), quality.V1)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "fail_bits", "sole_rule", "policy")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3's policies reject and what each of their rules alone rejects, from the stored ledger."""
    return quality.ablations(stage(quality.ledger(read_table(spark, sf_dir, "documents")), "quality-ledger"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_hash")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontamination.decontaminate(documents, items).drop("text_hash")


def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5, which now returns both kinds of matches."""
    return op5_benchmark_decontamination(spark, sf_dir)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("text_hash")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read_table(spark, sf_dir, "documents"))
    return plan.selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken", "copies")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_rows(read_table(spark, sf_dir, "documents"))


def token_file_rows(documents: DataFrame) -> DataFrame:
    folder = files.new_folder(documents.sparkSession, "tokens")
    manifest = token_files.write_token_files(documents, public_tokenizers.path(token_files.TOKENIZER), folder)
    return token_files.read_token_files(manifest, folder)


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.repeated_passages(read_table(spark, sf_dir, "documents")).drop("text_hash")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(token_counts.VOCABULARY))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return alignment.token_alignment(documents, public_tokenizers.path(alignment.VOCABULARY_A), public_tokenizers.path(alignment.VOCABULARY_B))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(read_table(spark, sf_dir, "documents"))


#: Some labels are made wrong on purpose.
NOISY_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END"


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), label=NOISY_LABEL)


QUERIES = {
    "op1_privacy": op1_privacy,
    "op2_warc_writer": op2_warc_writer,
    "op3_quality_rules": op3_quality_rules,
    "quality_ablations": quality_ablations,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "benchmark_proximity": benchmark_proximity,
    "op6_toxicity": op6_toxicity,
    "op8_mix_sources": op8_mix_sources,
    "op7_token_files": op7_token_files,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_token_counts": op10_token_counts,
    "op11_token_alignment": op11_token_alignment,
    "op12_fingerprints": op12_fingerprints,
    "op13_hard_negatives": op13_hard_negatives,
}
#: Pre-tokens, tokenizer files and learned models are no SQL; tests compare those queries with brute force.
ORACLES: dict[str, str] = {
    "op13_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id,
    CAST(list_sum(list_transform(a.q, lambda x, i: x * v.q[i])) AS BIGINT) AS score
  FROM v AS a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
""",
    "op2_warc_writer": r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p
), d AS (
  SELECT page_id, strlen(h) AS payload_bytes, first_id, list_transform(range(0, 8), lambda g: CAST('0x' || substr(x, 5 * g + 1, 5) AS BIGINT)) AS v FROM f
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM d
""",
    "op5_benchmark_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), s AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM s
), runs AS (
  SELECT doc_id, n, list_transform(range(1, greatest(len(w) - n + 2, 1)), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' ')) AS g
  FROM d, (SELECT DISTINCT n FROM windows)
), spots AS (
  SELECT doc_id, n, unnest(range(1, len(g) + 1)) AS i, unnest(g) AS g FROM runs
), found AS (
  SELECT doc_id, i, windows.n AS n, item_id FROM spots JOIN windows USING (n, g)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM found) GROUP BY doc_id
), item_terms AS (
  SELECT item_id, len(w) AS l, unnest(range(len(w))) AS ipos, unnest(w) AS term FROM (SELECT DISTINCT item_id, w FROM b WHERE len(w) > 0)
), postings AS (
  SELECT * FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM item_terms)
), frequencies AS (
  SELECT term, count(*) AS f FROM postings GROUP BY term
), places AS (
  SELECT *, unnest(range(greatest(ipos - 9, 0), least(ipos, greatest(l - 10, 0)) + 1)) AS wstart FROM item_terms
), seeds AS (
  SELECT DISTINCT item_id, ipos, term FROM (
    SELECT item_id, ipos, term, row_number() OVER (PARTITION BY item_id, wstart ORDER BY coalesce(f, 0), ipos) AS k FROM places LEFT JOIN frequencies USING (term)) WHERE k <= 3
), needed AS (
  SELECT item_id, least(4, count(*)) AS needed FROM seeds GROUP BY item_id
), lists AS (
  SELECT doc_id, item_id, ipos, pos - ipos AS diag FROM postings JOIN seeds USING (term)
), met AS (
  SELECT x.doc_id, x.item_id, x.diag, count(DISTINCT y.ipos) AS met FROM (SELECT DISTINCT doc_id, item_id, diag FROM lists) AS x
  JOIN lists AS y ON x.doc_id = y.doc_id AND x.item_id = y.item_id AND y.diag BETWEEN x.diag AND x.diag + 5 GROUP BY ALL
), near AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near_items FROM met JOIN needed USING (item_id) WHERE met >= needed GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near_items, 0) AS n_near_items
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
""",
    "op8_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(concat_ws(chr(1), coalesce(CAST(doc_id AS VARCHAR), chr(0)), coalesce(text, chr(0)), coalesce(lang, chr(0)), coalesce(source, chr(0)), coalesce(CAST(n_chars AS VARCHAR), chr(0)))), 1, 15) AS BIGINT) AS h
  FROM documents
), c AS (
  SELECT *, length(bin(size)) AS k FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM c GROUP BY source
), o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS ws,
    coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_size,
    coalesce(sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_w FROM s
), q AS (
  SELECT *, (3 * total - 4 * before_size) * w >= 4 * source_size * (ws - before_w) AS capped FROM o
), t AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE)
    ELSE CAST(w * (3 * total - 4 * sum(CASE WHEN capped THEN source_size ELSE 0 END) OVER ()) AS DOUBLE) / CAST(2 * sum(CASE WHEN capped THEN 0 ELSE w END) OVER () AS DOUBLE) END AS target,
    CAST('0x' || substr(md5(concat_ws(chr(1), coalesce(source, chr(0)), '17')), 1, 7) AS BIGINT) / 268435456.0::DOUBLE AS u FROM q
), z AS (
  SELECT *, h % CAST(ceil(sqrt(count(*) OVER (PARTITION BY source, k))) AS BIGINT) AS b FROM c
), r AS (
  SELECT z.*, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS ratio,
    row_number() OVER (PARTITION BY z.source ORDER BY k, b, size, h, doc_id) AS n FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source
), x AS (
  SELECT *, CAST(floor(ratio) + floor(u + (ratio - floor(ratio)) * n) - floor(u + (ratio - floor(ratio)) * (n - 1)) AS BIGINT) AS copies FROM r
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM x
""",
    "op3_quality_rules": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), runs AS (
  SELECT doc_id, list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: array_to_string(list_slice(w, i, i + 7), ' ')) AS g FROM d
), spots AS (
  SELECT doc_id, unnest(range(1, len(g) + 1)) AS i, unnest(g) AS g FROM runs
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM spots
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)
), r AS (
  SELECT *, [n_words < 20, 100 * n_repeat_words > 30 * n_words, n_words > 1000000, word_chars < 2 * n_words,
    word_chars > 20 * n_words, 10 * n_symbols > 3 * n_words, 10 * n_dup_lines > 5 * n_lines, 100 * n_repeat_words > 10 * n_words] AS f FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f[1] OR f[2] AS base_failed,
  NOT list_bool_or(f[1:7]) AS kept, n_lines,
  CAST(list_sum(list_transform(f, lambda x, i: CASE WHEN x THEN 1 << (i - 1) ELSE 0 END)) AS BIGINT) AS fail_bits,
  CASE WHEN len(list_filter(f[1:7], lambda x: x)) = 1 THEN ['too_few_words', 'repeated_windows', 'too_many_words', 'mean_word_short',
    'mean_word_long', 'symbol_words', 'duplicate_lines'][list_position(f[1:7], true)] END AS sole_rule, 'v1' AS policy
FROM r
""",
}

ORACLES["benchmark_proximity"] = ORACLES["op5_benchmark_decontamination"]
_CASES = ", ".join(
    f"('{policy.version}', {policy.mask}, '{rule.name}', {1 << i})"
    for policy in quality.POLICIES
    for i, rule in enumerate(quality.RULES)
    if policy.mask >> i & 1
)
ORACLES["quality_ablations"] = f"""
SELECT cases.policy, rule, count(*) AS documents, count(*) FILTER (WHERE fail_bits & mask <> 0) AS rejected,
  count(*) FILTER (WHERE fail_bits & bit <> 0) AS failing, count(*) FILTER (WHERE fail_bits & mask = bit) AS kept_without
FROM ({ORACLES["op3_quality_rules"]}) CROSS JOIN (VALUES {_CASES}) cases(policy, mask, rule, bit) GROUP BY cases.policy, rule"""
