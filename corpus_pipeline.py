"""A corpus made ready for training: clean documents, one of each group of copies, packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.decontaminate import drop_leaks
from llm.exact_dedup import drop_exact_copies
from llm.jaccard_join import Threshold, keep_one_of_each
from llm.packing import pack_documents
from llm.queries import table, tokenizer_path
from llm.toxicity import drop_toxic
from llm.workers import importable
from tidymart.session import written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half stay; learned from the labels of rows that are not held out."""
    importable(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    importable(spark)
    return drop_exact_copies(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard similarity of 0.8 or more on five-word runs the least id stays."""
    importable(spark)
    return keep_one_of_each(docs, Threshold(n=5, part=80, whole=100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or one a few words away from it, go."""
    importable(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, with their sequence and place."""
    importable(spark)
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: Scores, edit distances and tokens are beyond SQL; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
