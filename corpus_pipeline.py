"""A corpus pipeline: language ID, exact and near deduplication, substring deduplication, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of documents.

* language: documents whose language is unknown (null text or no letter) go.
  Profiles are learned from the training rows of the documents themselves;
  where these give none, every text with a letter stays.
* exact: of equal texts (up to white space) the smallest doc_id stays.
* near: of each group of near-duplicates (word shingles of five, similarity
  0.8 or more) the smallest doc_id stays.
* substring: words under a repeated window of 35 words are taken out of the
  texts; every document stays, if need be with an empty text.
* packing: what is left is tokenised and packed into sequences of 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, staged
from tidemill.llm.exact import drop_copies
from tidemill.llm.language import UNKNOWN, fit_profiles, has_letter, predicted_language, training_rows
from tidemill.llm.neardup import drop_near_copies
from tidemill.llm.packing import pack_documents
from tidemill.llm.substring import remove_repeats

NEAR_PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = fit_profiles(training_rows(docs))
    if not profiles.languages:
        return docs.filter(has_letter(F.col("text")))
    return docs.filter(predicted_language(F.col("text"), profiles, spark) != UNKNOWN)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, NEAR_PERCENT)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", known_language),
    ("exact", exact_dedup),
    ("near", near_dedup),
    ("substring", substring_dedup),
    ("packing", packing),
]

#: The stages go beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        own = Scratch(spark)
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}", own)
        last.clear()  # nothing reads the stage before any more
        last = own
    return STAGES[-1][1](spark, docs, sf_dir)
