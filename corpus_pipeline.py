"""The corpus pipeline: rules, classifier, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet in the shared folder and reads them back as the next
one's ``docs``. All but the last return the columns of ``docs``. Nulls in any column,
empty and very long texts, ties, repeated rows, empty tables and clashing extra columns
have the results that the operators' own docstrings define.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parkwright.llm import mixing, packing, quality_fm, quality_rules, simhash_dedup
from parkwright.llm.queries import tokenizer
from parkwright.llm.shared import settled


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules keep."""
    return quality_rules.filter_documents(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes as good; it learns from the labels of the whole table, held-out rows apart."""
    machine = quality_fm.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_fm.keep_good(docs, machine)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return simhash_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that mixes their sources to weights by the root of their size."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document in the packed sequences, which are numbered in the mixed order.

    Rows come back from a file in the order they were written in, so what is packed
    together stands together in the mix. Files don't, so sequences are numbered by the
    places of their documents in the mix, which are found anew from ids and sources.
    """
    places = mixing.mix(docs.select("doc_id", "source")).select("doc_id", F.col("position").alias("place"))
    return packing.in_order(packing.pack(docs, *tokenizer()), places)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("simhash near-dedup", near_dedup),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, a trained model and tokenizers are beyond SQL; a test holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what earlier stages left in the shared folder is deleted as soon as their own rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, partial(stage, spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
