"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martforge.llm import (
    chat,
    hard_negatives,
    hmm,
    html_extract,
    kneser_ney,
    mixing,
    packing,
    pii,
    quality_rules,
    sharding,
    simhash,
    whitening,
    winnowing,
)
from martforge.llm.common import read_table


def op1_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(read_table(spark, sf_dir, "documents"))


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


def op3_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_chat_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(chat.with_probe(read_table(spark, sf_dir, "conversations")))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.decontamination_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents"))


def op7_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op8_html_max_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op9_simhash_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(read_table(spark, sf_dir, "documents"))


def op10_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_report(read_table(spark, sf_dir, "documents"))


def op11_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(read_table(spark, sf_dir, "documents"))


def op12_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pii_weak_supervision, op2_minimax_shards, op3_kneser_ney_quality, op4_chat_assembly, op5_winnowing,
    op6_rule_ledger, op7_entropy_mix, op8_html_max_run, op9_simhash_bit_sliced, op10_hmm_scores,
    op11_cost_balanced_packing, op12_polarised_whitening, op13_kronecker_negatives, pipeline)}

_CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, 6 + 7 + 4 + len(role) + len(text)
    + len(regexp_extract_all(role, '[<\[]\\*(?:/?s>|/?INST\])'))
    + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?INST\])')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WINDOW_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all({_LOWER.format(t="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER.format(t="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, span, array_to_string(w[s:s + span - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS span, unnest(range(1, greatest(2, len(w) - 8))) AS s FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, s, span, array_to_string(w[s:s + span - 1], ' ') AS win
  FROM (SELECT r, w, span, unnest(range(1, len(w) - span + 2)) AS s
        FROM d, (SELECT DISTINCT span FROM bw) WHERE len(w) >= span)),
hit AS (SELECT r, s, dw.span, item_id FROM dw JOIN bw ON dw.span = bw.span AND dw.win = bw.win),
hw AS (SELECT r, count(DISTINCT p) AS n_hit
       FROM (SELECT r, unnest(range(s, s + span)) AS p FROM (SELECT DISTINCT r, s, span FROM hit)) GROUP BY r),
hi AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""

_RULES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT r, s, array_to_string(w[s:s + 7], ' ') AS gram
      FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS s FROM d WHERE len(w) >= 8)),
twice AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + 8)) AS p FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(regexp_extract_all(t, '[A-Z]')) AS BIGINT) AS n_upper
  FROM d LEFT JOIN rep USING (r)),
f AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
    + 4 * (100 * n_symbols > 30 * n_words)::INT + 8 * (n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines)::INT
    + 16 * (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))::INT
    + 32 * (2 * n_upper > word_chars)::INT AS BIGINT) AS fail_bits FROM m)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, 'v2' AS policy FROM f
"""

ORACLE: dict[str, str] = {
    "op4_chat_assembly": _CHAT_SQL,
    "op5_winnowing": _WINDOW_SQL,
    "op6_rule_ledger": _RULES_SQL,
}
