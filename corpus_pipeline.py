"""A corpus from raw documents to packed sequences: every stage is one operator over what is left.

The result of a stage is to be written and read again before the next stage is called, as ``run``
does: a stage first removes the intermediate tables that earlier stages called in this thread
have left, except those its own input reads.
"""

from __future__ import annotations

from functools import wraps
from threading import local

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import noting, quoted, release, saved, text_mark, without
from changeflow.llm.decontaminate import find_contaminated
from changeflow.llm.exact_dedup import deduplicated
from changeflow.llm.ngram_join import one_of_each
from changeflow.llm.packing import pack_documents
from changeflow.llm.toxicity import score_toxicity


_LEFT = local()


def _stage(function):
    """Have a stage start by removing what the stages before it have left."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        folders = _LEFT.__dict__.setdefault("folders", [])
        release(docs, folders)
        with noting(folders):
            return function(spark, docs, sf_dir)

    return run_stage


def _rejected(docs: DataFrame, judged: DataFrame) -> DataFrame:
    gone = judged.select("doc_id", F.col("text_mark").alias("key"))
    return without(docs, saved(gone, "rejected"), text_mark(quoted("text")), "doc_id")


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is not predicted."""
    judged = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _rejected(docs, judged.filter("predicted = 1"))


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, the one with the smallest id."""
    return deduplicated(docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group linked by runs of five words and a similarity of 0.8."""
    return one_of_each(docs, size=5, percent=80)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    judged = find_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _rejected(docs, judged.filter("contaminated"))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: Trained scores, tokens and packing are beyond SQL; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
