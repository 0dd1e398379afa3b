"""From documents to packed sequences: filter, remove near copies and repeated passages, pack.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and is written as
Parquet for the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import classifier, order_minhash, rules, suffixes
from newsflow.llm.common import configure, spread, stored, table
from newsflow.llm.queries import bad_documents, packed

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior probability of low quality or toxicity is a half or more go."""
    docs = spread(docs)
    model = bad_documents(configure(spark), sf_dir, docs)
    judged = classifier.judge(docs, model, F.col("source"), F.col("lang"))
    return judged.where("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the policy go."""
    configure(spark)
    return rules.passing(spread(docs), "v1")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    configure(spark)
    return order_minhash.one_of_each(spread(docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte in a string of 200 bytes that repeats goes; documents stay with what is left."""
    configure(spark)
    rest = suffixes.without_repeats(spread(docs.select(F.struct("*").alias("row"), "doc_id", "text")), as_text=True)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return rest.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    configure(spark)
    return packed(spread(docs.select("doc_id", "text")))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

# Models, sketches and tokenizers are not expressible in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of the table documents."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
