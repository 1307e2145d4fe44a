"""A corpus pipeline of five stages over ``documents``.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  All but the last give the columns
of documents; what a stage gives is written as Parquet and read again for the next one.

1. language: a document whose language cannot be told (no letters, or a calibrated probability
   under one half) goes; a missing lang is filled in.
2. near_duplicates: SimHash over five-word shingles, similarity 0.8; of each group the document
   with the least doc_id stays.
3. personal_data: every span found is replaced by its kind; n_chars follows the new text.
4. mixing: toxic text gets target weight zero, good and poor text about what they have; documents
   are repeated where their rate is above one and dropped where it is under one half.  Rates are
   held to one (``mixing.HOLD``): posteriors give clean text a little toxic mass too, and meeting
   zero exactly would take most of it along.
5. encoding: ids and decoded text of every document under the public word vocabulary.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm import bpe, language_id, mixing, pii, simhash
from duskwatch.llm.common import DOCUMENT_COLUMNS, small_batches, table, with_results
from duskwatch.llm.queries import DOMAIN_WEIGHTS, DOMAINS, labelled_domains
from duskwatch.sources.staging import stage

LEAST_SCORE = 0.5


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*DOCUMENT_COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = language_id.fit(docs)
    told = language_id.identify(_documents(docs), model)
    kept = told.where(
        (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    )
    return _documents(kept.withColumn("lang", F.coalesce("lang", "lang_pred")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that of least doc_id (then of least text hash)."""
    small_batches(spark)
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("text").alias("h"))
    docs = _documents(docs).withColumn("row_key", key)
    found = simhash.near_duplicates(docs, simhash.SIMILAR, key="row_key")
    kept = found.where("row_key = component_id").groupBy("row_key").agg(F.count("*").alias("rows"))
    kept = stage(kept, "kept")  # decided once; read for both kinds of row below
    single = docs.join(kept.where("rows = 1"), "row_key", "left_semi")
    # rows equal in doc_id and text are one document
    equal = docs.join(kept.where("rows > 1"), "row_key", "left_semi")
    one = equal.groupBy("row_key").agg(F.first(F.struct(*DOCUMENT_COLUMNS)).alias("d"))
    return _documents(single).union(_documents(one.select("d.*")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    tagger = pii.fit(docs)
    clean = _documents(docs).withColumn("text", pii.redacted(F.col("text"), tagger))
    return clean.withColumn("n_chars", F.char_length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = mixing.fit(docs, labelled_domains(table(spark, sf_dir, "labels")), DOMAINS)
    rated = mixing.mix(_documents(docs), model, DOMAIN_WEIGHTS, keep_all=True)
    number = mixing.copies(F.col("rate"), F.col("doc_id"), F.col("text"))
    repeated = rated.withColumn("copies", number).where("copies > 0")
    return _documents(
        repeated.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    )


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    fields = ["n_tokens", "ids_sha256", "decoded_sha256"]
    return with_results(docs, bpe.token_digests(F.col("text"), path), ["doc_id", "lang", "source"], fields)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mix),
    ("encoding", encoding),
]

# Trained models and fingerprint groups decide which rows stay: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each over the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
