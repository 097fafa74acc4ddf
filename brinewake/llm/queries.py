"""The operators as queries over the tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import chat_format, decontam, language_id, license_scan, line_dedup, ngram_join, packing, quality_rules, secret_scan, toxicity
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def digests(packed: DataFrame, *more: str) -> DataFrame:
    """The pieces with their ids as a checksum."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", *more)


def n_chars(kind) -> Column:
    return F.length("text").cast(kind)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    # each row is an event that sets a message of its own
    order = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text"))
    events = rows.unionByName(probe).select("conv_id", order.cast("long").alias("seq"), order.cast("long").alias("message"), F.lit("message").alias("kind"), "role", "text")
    back = chat_format.parse(chat_format.format_conversations(events))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~held_out()))
    return language_id.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_deleted")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs.where(~held_out()), table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


_OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), coded AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) AS body,
         length(role) + length(regexp_replace(role, '[^\\<#:]', '', 'g')) AS head
  FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + head + 2 + body + 8)::BIGINT AS formatted_chars
FROM coded GROUP BY conv_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_quality_rules": op2_quality_rules,
        "op3_license_scan": op3_license_scan,
        "op4_packing": op4_packing,
        "op5_chat_format": op5_chat_format,
        "op6_ngram_join": op6_ngram_join,
        "op7_decontamination": op7_decontamination,
        "op8_language_id": op8_language_id,
        "op9_line_dedup": op9_line_dedup,
        "op10_toxicity": op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_chat_format": _OP5_SQL}
