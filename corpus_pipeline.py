"""The corpus pipeline: documents to token ids, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.contamination import decontaminated
from tickloom.llm.language import identified, learned
from tickloom.llm.near_dup import near_duplicates
from tickloom.llm.passages import without_repeats
from tickloom.llm.pieces import encoded, vocabulary
from tickloom.llm.store import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in none of the languages learned from them go: those without a
    letter, null and empty ones included, and those far from every centroid."""
    return identified(docs, learned(docs)).where("NOT rejected").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id.

    Rows of that doc_id stay together, rows without doc_id stay.
    """
    dropped = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of all documents but the first; emptied documents go."""
    return without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, n_bytes, exact, tokens) of each document's whole text."""
    return encoded(docs, vocabulary()).select(
        "row.doc_id", "row.lang", "row.source", "n_tokens", "n_bytes", "exact", "tokens"
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: No stage but decontamination has a form in SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
