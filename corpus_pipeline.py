"""The corpus pipeline: five stages over documents, each one operator, each written before the next one reads it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import exact, ngram, packing, secrets, toxicity
from wakeline.llm.common import DOCUMENT_COLUMNS, table
from wakeline.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score calls toxic go. A null or empty text is judged by the score of such."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("predicted") == 0).select(*DOCUMENT_COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the row with the smallest doc_id stays."""
    return exact.exact_dedup(docs).where("kept").select(*DOCUMENT_COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked texts the document with the smallest doc_id stays; the others are taken out by key."""
    gone = ngram.near_duplicates(docs.select("doc_id", "text")).where(~F.col("kept")).select("row_key").distinct()
    keyed = docs.select(*DOCUMENT_COLUMNS, ngram.row_key(docs, "text", "doc_id").alias("row_key"))
    return keyed.join(gone, "row_key", "left_anti").select(*DOCUMENT_COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret gives way to a mark, and n_chars to the new length; texts without one stay as they are."""
    found = secrets.scan(docs.select(*DOCUMENT_COLUMNS))
    text = secrets.redact(F.col("text"), F.col("spans"))
    changed = F.size("spans") > 0
    return found.withColumn("clean", text).select(
        "doc_id", F.col("clean").alias("text"), "lang", "source",
        F.when(changed, F.char_length("clean").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in the sequences, as op10 gives them."""
    return packing.digest(packing.pack(docs.select("doc_id", "text"), added_tokens=True))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written to the shared folder and read by the next."""
    folder = f"{shared_dir(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: A learnt score and a tokenizer are beyond SQL; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None
