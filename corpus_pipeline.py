"""From raw documents to packed training sequences, one operator per stage.

Each stage takes (spark, docs, sf_dir), works on every document its predecessor
kept, and returns documents with the columns of the table; the last returns the
pieces of the packed sequences. Between stages documents are written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatlens.llm import jaccard, neighbours, packing, pii, rules
from seatlens.session import stage


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their nearest labelled neighbours vote for."""
    learn = ~neighbours.held_out("doc_id", 4, 2)
    return neighbours.keep_predicted(docs, _labels(spark, sf_dir), learn=learn)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the fixed rules nor the isolation forest reject."""
    return rules.keep_good(docs, _labels(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return jaccard.keep_one(docs, shingle=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs


#: Learnt models and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None
