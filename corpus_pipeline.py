"""A corpus pipeline of five operators; each stage works on all that the one before kept.

``run`` writes each stage's result under the session's checkpoint folder and
reads it back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chanmart.llm.common import prepare, staged
from chanmart.llm.decontaminate import decontaminate
from chanmart.llm.line_dedup import dedup_lines
from chanmart.llm.near_dup import one_of_each
from chanmart.llm.packing import packed_documents
from chanmart.llm.toxicity import THRESHOLD, score_toxicity, trained


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the classifier rejects are gone; all columns and texts of the others stay."""
    scored = score_toxicity(docs, trained(spark, sf_dir, docs), score_col="__toxicity")
    return scored.filter(scored["__toxicity"] < THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines found in ten documents or more are gone; every document stays."""
    return dedup_lines(docs, min_docs=10, min_chars=1).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each class of near copies the document of smallest id stays."""
    return one_of_each(docs)


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: the spans of ten words or more that an item has too are cut out."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left into sequences of at most 2048 tokens."""
    return packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", remove_benchmark_passages),
    ("best_fit_packing", pack),
]

#: Learned scores and connected components of near copies have no SQL form; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
