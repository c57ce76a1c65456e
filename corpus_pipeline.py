"""The corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir) with the rows its predecessor kept, and all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hypnolith.llm import decontamination, mixing, quality_rules, signature_trees, token_files
from hypnolith.llm.queries import vocabulary
from hypnolith.llm.tables import read_table, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.passing(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of every group of near copies."""
    return signature_trees.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and per document what is read back from them."""
    return token_files.read_token_files(token_files.write_token_files(docs, vocabulary()))


STAGES = [
    ("quality_rules", quality),
    ("near_copies", near_copies),
    ("decontamination", benchmark),
    ("mixing", mix),
    ("token_files", tokens),
]

#: Shingle links, edit distances and token files are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
