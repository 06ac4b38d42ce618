"""Corpus pipeline: documents through five of the text operators, in order.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the
columns of ``docs``; the last one returns the encoded documents.  ``run``
writes every stage as Parquet in the shared folder and reads it again as the
next one's input, so each stage works on all that its predecessor kept.

Defined cases: rows with null texts have no words, shingles or n-grams; they
pass the classifiers, link with nothing, hold no benchmark passage and get null
ids.  Extra columns go through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, importance, ngram_join, pieces, toxicity
from shelfwise.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling draws."""
    ratio = importance.fit(spark, docs, table(spark, sf_dir, "labels"))
    return importance.resample(spark, docs, ratio)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity stays under 0.7."""
    model = toxicity.train(spark, docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(spark, docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: that of the smallest id."""
    return ngram_join.one_of_each(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't contaminated by the benchmark."""
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids, round_trip): the piece ids of each document, and whether they decode to its text."""
    out = pieces.encode(docs.select("doc_id", "text"), pieces.load(), check="round_trip", keep=["doc_id"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", encoding),
]

#: Classifiers, components and pieces are not for SQL; tests/llm hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
