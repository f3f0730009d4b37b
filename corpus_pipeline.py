"""From documents to packed training sequences.

``STAGES`` are applied in order; each reads what its predecessor wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import decontaminate, lines, packing, quality, simhash
from tidewell.llm.common import written
from tidewell.session import read_table

#: The stages learn from the corpus, hash and tokenize, which SQL cannot express.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes aligned common blocks of lines from the later documents; a
    document that has no word left goes."""
    return lines.dedup_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group."""
    return simhash.keep_first(docs, width=3, bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold passages of the benchmark."""
    return decontaminate.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the documents' pieces in training sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules),
          ("line dedup", line_dedup),
          ("SimHash near-dedup", simhash_near_dedup),
          ("benchmark decontamination", benchmark_decontamination),
          ("best-fit packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
