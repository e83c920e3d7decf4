"""Corpus pipeline: documents -> packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of ``documents``.  Stages are written as Parquet and read
again, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, lines, nbsvm, neardup, packing
from quarry.llm.queries import tokenizer_path
from quarry.session import cut_lineage
from quarry.sources.tables import table

SHINGLE = 5  # words of a shingle in the near-duplicate stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones; texts as they are."""
    found = nbsvm.classify(docs, table(spark, sf_dir, "labels"))
    return found.where(F.col("predicted") == 1).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its later copies of repeated runs; ``n_chars`` follows the text."""
    done = lines.dedup(docs)
    shorter = F.size(done.columns[-1]) > 0
    return done.select(*[F.when(shorter, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                         if c == "n_chars" else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and every other document."""
    drop = neardup.near_duplicates(docs, size=SHINGLE).where(~F.col("kept")).select("doc_id")
    return docs.join(drop, "doc_id", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    drop = found.where(F.col("contaminated")).select("doc_id")
    return docs.join(drop, "doc_id", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]
# A trained classifier and a tokenizer have no SQL form; tests/llm holds the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
