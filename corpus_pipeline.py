"""A corpus pipeline of five operators of ``rollcall.llm``.

Each stage takes ``(spark, docs, sf_dir)``, works on everything the one before kept, and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``documents``.

Every stage takes nulls in any column, empty and very long texts, repeated rows, tables without rows,
and further columns of any name, which pass through: a null or empty text fails the quality rules, a
null id is a document of its own, and repeated rows are copies, of which one stays.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rollcall.llm.mixing import mix  # noqa: E402
from rollcall.llm.ngram_join import one_of_each  # noqa: E402
from rollcall.llm.pieces import encode_documents  # noqa: E402
from rollcall.llm.quality import passing  # noqa: E402
from rollcall.llm.store import forget, table, written  # noqa: E402
from rollcall.llm.substring_dedup import dedup_substrings  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language go; equal rows go or stay together."""
    return passing(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays; documents without words all stay."""
    row = docs.select(F.struct("*").alias("row"), "doc_id", "text")  # its columns may have any names
    return one_of_each(row, n=5, percent=80).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeated passages go; a document keeps the rest of its words, joined by one space, and its row."""
    others = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    out = dedup_substrings(docs, carry=others)
    return out.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is there as often as the mix takes it."""
    rows, _ = mix(docs.select(F.struct("*").alias("row"), "doc_id", "text", "source"))
    rows = rows.where("_passes > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_passes")))
    return rows.select("row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document."""
    return encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), name)
        if hasattr(before, "written_at"):
            forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
