"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsift.llm import (
    bpe,
    chat,
    fingerprints,
    hmm,
    line_dedup,
    merkle,
    mixing,
    near_dup,
    quality_rules,
    sharding,
    spelling,
    sql,
    suffixes,
    url_filter,
)
from rowsift.llm.common import documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_table(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.language_scores(documents(spark, sf_dir))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_table(spark, documents(spark, sf_dir))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edit(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_by_source(documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(documents(spark, sf_dir).select("doc_id", "n_chars"))
    return placed.select("doc_id", "slot", "shard", "n_chars")


#: Rows that the contract adds to the conversations: both texts hold the strings of common templates.
PROBE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(PROBE, "conv_id bigint, turn bigint, role string, text string"))
    parts = turns.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.digests(chat.format_conversations(parts))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(documents(spark, sf_dir, "pages"), url_filter.train(url_filter.seed_table(spark)))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return line_dedup.line_report(docs, line_dedup.build_state(docs))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_report(documents(spark, sf_dir))


def op12_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.cut_report(documents(spark, sf_dir))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_model": op2_language_model,
    "op3_bpe": op3_bpe,
    "op4_fingerprints": op4_fingerprints,
    "op5_mixing": op5_mixing,
    "op6_sharding": op6_sharding,
    "op7_chat": op7_chat,
    "op8_url_filter": op8_url_filter,
    "op9_line_dedup": op9_line_dedup,
    "op10_near_dup": op10_near_dup,
    "op11_merkle": op11_merkle,
    "op12_suffixes": op12_suffixes,
    "op13_spelling": op13_spelling,
}

_LINES = r"""
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(s) AS l, unnest(range(len(s))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))
), frequent AS (
  SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.*, coalesce(l.doc_id < f.last, FALSE) AS gone FROM lines l LEFT JOIN frequent f USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, regexp_replace(replace(text, '\', '\b'), '<(/?turn|\|)', '\\l\1', 'g') AS escaped,
    replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g'), chr(10), '\n') AS escaped_role
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(escaped) + length(escaped_role) + 15)::BIGINT AS formatted_chars,
  0::BIGINT AS attachment_tokens
FROM marked GROUP BY conv_id
"""

ORACLE = {"op7_chat": _CHAT, "op9_line_dedup": _LINES, "op11_merkle": sql.MERKLE, "op13_spelling": sql.SPELLING}
