"""Corpus pipeline: quality, exact copies, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of ``documents``. ``run`` applies them to the documents of ``sf_dir``; between stages rows are written
in the shared folder and read again, so a lost executor never costs more than a stage.

Stages that filter keep clean documents: one goes only if its score is below the threshold of the
classifier, if a copy of it stays, or if it holds a benchmark window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colloq.llm import decontaminate, exact_dedup, packing, quality, simhash
from colloq.llm.common import load, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (10)."""
    rules = quality.train(docs, load(spark, sf_dir, "labels"))
    return quality.keep_good(docs, rules)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest doc_id (3)."""
    return exact_dedup.keep_rows(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id (5)."""
    return simhash.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window (7)."""
    return decontaminate.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and offsets (2)."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("best-fit packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
