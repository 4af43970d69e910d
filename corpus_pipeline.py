"""The corpus pipeline: language ID, exact dedup, near-dedup, benchmark decontamination, packing.

Each stage takes the documents that the one before kept, as a written table, and drops what its
operator decides on; the last one returns the packed pieces.  A stage works on whole texts and
keeps all columns of ``documents``.

- ``language``: rows whose text is null or has no letter, or is too far from every language's
  centroids, go.  The prediction replaces nothing.
- ``exact``: of equal texts the row with the largest doc_id stays.
- ``near``: of each group of near-duplicates (five-word shingles, similarity 0.8) the row with the
  least doc_id stays.
- ``benchmark``: documents with a passage of a benchmark item (five-word shingles, 0.8) go.
- ``pack``: the rest is cut and packed into sequences of 4,096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audience_engine.llm.common import by_text, cut_lineage, table, without
from audience_engine.llm.decontaminate import drop_contaminated
from audience_engine.llm.exact_dedup import drop_exact_copies
from audience_engine.llm.langid import identify, train
from audience_engine.llm.near_dedup import drop_near_copies
from audience_engine.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, identify(by_text(docs), train(docs)).where("rejected").select(F.col("doc_id").alias("text_sha256")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, k=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), k=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("language", language), ("exact", exact), ("near", near), ("benchmark", benchmark), ("pack", packing)]

#: The fitted models and the tokenizer cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
