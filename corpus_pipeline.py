"""From raw documents to training tokens: five stages, each of one operator.

Every stage takes what the one before kept, as a table with the columns of documents, and its
decisions take effect there: rejected rows and copies are gone, personal data is
masked, a document stands as often as the mix takes it.  The last returns token ids.

Null, empty and very long texts, null sources and languages and repeated rows go through as the
operators define; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogproof.llm import bpe, jaccard, mixing, pii, quality, words
from catalogproof.llm.queries import MAX_EPOCHS, curriculum, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: rows of a batch that goes to a Python worker: whole texts are long, and executors hold a few batches for every core
BATCH_ROWS = 1000


def batched(spark: SparkSession) -> None:
    """Set, for the session, the rows of a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    batched(spark)
    return quality.filter_quality(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of exact and near copies the least doc_id stays."""
    batched(spark)
    return jaccard.keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: each span is replaced by the mark of its kind; texts without one stay as they are."""
    batched(spark)
    masked = pii.redact(docs.select(*COLUMNS), pii.train(docs))
    n_chars = F.when(F.col("n_spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a row for each time a document is taken, in training order."""
    sized = docs.select(*COLUMNS, words.count(F.col("text")).alias("size"))
    return mixing.mix(sized, curriculum(docs), max_epochs=MAX_EPOCHS).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: doc_id, source, lang, ids, the digest of the text they decode to and their number, for every row of the mix."""
    batched(spark)
    texts = docs.select("doc_id", "source", "lang", "text")
    ids = bpe.encode(texts, vocabulary("word_bpe_49k.json"), decoded="decoded_sha256").drop("text")
    return ids.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]

#: the boosted trees and the vocabulary's merges are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
