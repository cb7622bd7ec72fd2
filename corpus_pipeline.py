"""Corpus pipeline: quality rules, near-dedup, substring dedup, PII, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; it
is judged on its own input. All but the last return the columns of documents. Stages follow
each other through Parquet tables in the shared folder.

Defined cases of every stage: an empty table gives an empty one; a null text counts as empty; a
row without an id is judged by its text alone and never as another's copy; further columns,
whatever their names, are carried along by all stages but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import minhash, packing, pii, quality, substring
from attestry.llm.spark import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and are likelier good than bad."""
    return quality.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component.

    Five-word shingles, similarity 0.8 or more. Rows that share an id stay or go together,
    of rows equal in id and text one stays; a row without an id stays.
    """
    found = minhash.near_duplicates(docs, width=5, percent=80)
    gone = found.where("not kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null")
    named = named.dropDuplicates(["doc_id", "text"]) if _repeats(docs) else named  # the same rows either way, without a shuffle of texts if it can be spared
    return named.join(gone, "doc_id", "left_anti").select(*docs.columns).union(docs.where("doc_id is null"))


def _repeats(docs: DataFrame) -> bool:
    return bool(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count())


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words that an earlier document has; emptied documents go.

    A text that loses nothing keeps its white space.
    """
    return substring.cleaned(docs, length=50)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind in angle brackets."""
    masked = pii.masked(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a training sequence for every piece of every document."""
    return packing.packed(packing.word_lengths(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("pii", private_data),
    ("best_fit_packing", best_fit_packing),
]

#: The stages fit models, which SQL does not express; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
