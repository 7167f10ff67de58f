"""A corpus pipeline: drop toxic documents, drop near duplicates, mask secrets, pack.

Each stage takes (spark, docs, sf_dir) and works on all documents its
predecessor kept; ``run`` writes what a stage returns and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade.llm.common import drop_folder, shared_folder, table
from sitegrade.llm.harmonic_packing import pack
from sitegrade.llm.near_duplicates import near_duplicates
from sitegrade.llm.secrets import (
    find_secrets,
    labelled_samples,
    redacted,
    train as train_secrets,
)
from sitegrade.llm.toxicity import toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the toxicity score does not reject.

    Every row is decided by its own text, with or without a doc_id, repeated or
    not. A null or empty text is kept; an empty table stays empty.
    """
    scored = toxicity(docs, table(spark, sf_dir, "labels"), carry=COLUMNS[1:])
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the smallest doc_id, of each group of near duplicates.

    Rows that repeat a doc_id are one document, of which the row with the
    smallest text hash (then the smallest row) stays. A document without a doc_id
    is named by its text, after all others: it stays unless a document with an
    id, or an equal text, is in its group. Texts without words are in no group.
    """
    named = docs.select(*COLUMNS).withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    unnamed = F.shiftrightunsigned("mark", 2).bitwiseOR(1 << 62)
    named = named.withColumn("name", F.coalesce(F.col("doc_id").cast("bigint"), unnamed))
    counted = near_duplicates(named, doc_id="name", mark="mark").where("kept").groupBy(
        F.col("doc_id").alias("name"), "mark").agg(F.count("*").alias("n"))
    chosen = counted.groupBy("name").agg(F.min(F.struct("mark", "n")).alias("c")).select(
        "name", "c.mark", "c.n")
    found = named.join(chosen, ["name", "mark"])
    several = found.where("n > 1").groupBy("name").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return found.where("n = 1").select(*COLUMNS).unionByName(several.select("row.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep every document; texts lose their secrets, and n_chars follows the text.

    A null text becomes empty; repeated rows and null ids are handled each.
    """
    plain = docs.select("doc_id", "text")
    found = find_secrets(docs.select(*COLUMNS), train_secrets(labelled_samples(plain)))
    spans = F.array_sort(F.concat("base", "markov"))
    masked = found.withColumn("text", F.when(F.size(spans) > 0, redacted(F.col("text"), spans))
                              .otherwise(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, dealt to training sequences.

    Every row is packed, with or without a doc_id; an empty table has no pieces.
    """
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: The stages train models and hash texts, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again.

    What a stage read is removed once its own rows are written; the last stage's
    rows stay, for the caller to read.
    """
    docs = table(spark, sf_dir, "documents")
    folder, before = shared_folder(spark, "pipeline"), None
    for name, stage in STAGES:
        path = f"{folder}/{name}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            drop_folder(spark, before)
        before = path
    return docs
