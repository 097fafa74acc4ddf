"""Training-corpus pipeline: quality rules, line dedup, near duplicates, decontamination, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame; ``run`` writes each result to the shared scratch folder and reads it back.  Columns beyond
doc_id, text, lang and source pass through, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinewake.llm import decontam, line_dedup, ngram_join, packing, quality_rules, queries
from brinewake.llm.common import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or are outliers of their language and source go.

    Null and empty texts have no words and go; a null lang or source is a group like any other.
    """
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Common blocks of lines go from later documents, and a document of which nothing is left;
    n_chars, where there is one, follows a changed text.

    Null texts, null ids and texts that lose nothing stay as they are, empty ones too.
    """
    count = line_dedup.free_name("_lines_deleted", docs.columns)
    out = line_dedup.dedup_lines(docs, count_col=count)
    out = out.where((F.col(count) == 0) | (F.trim("text", F.lit(" \t\n\x0b\x0c\r")) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(count) == 0, F.col("n_chars")).otherwise(queries.n_chars(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least id stays.

    Texts without words have no duplicates, and rows without an id are not compared: they stay.  Rows
    that repeat the id that stays all stay.
    """
    return ngram_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none."""
    return decontam.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, one row per piece, with ids and their checksum.

    A null or empty text is its end id; repeated rows are packed each.
    """
    return queries.digests(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")), "ids")


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", sequences)]
#: Robust estimates, alignment, exact similarity components and tokenising are beyond SQL; the stages
#: are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
