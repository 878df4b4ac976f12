"""From raw documents to packed training sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) of the documents that its predecessor kept; its result is written as Parquet
and read again. Language ID keeps what it can attribute to a language; the two deduplications keep one document of each
group; the secret scan replaces secrets in the texts; packing returns the pieces of the documents and their sequences.

Stages keep and drop rows, not ids, so that rows with a null or repeated id are judged each by their own text. A null or empty text, or one
without letters, has no language and goes in the first stage. Of rows with equal texts one stays, and of repeated rows one.
Further columns of documents are kept, whatever their names, up to packing, which returns its own. An empty table gives an empty table.
Texts of any length are read whole. Tables that a stage writes for itself are deleted when its result is written, and so is the result before it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import exact_dedup, jaccard_join, langid, packing, secrets
from claimlake.llm.shared import delete, fresh_path, scratch

#: A document whose largest language has a smaller share than this belongs to no language.
MIN_LANGUAGE_SHARE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = langid.labelled(docs, langid.train(docs.where(~langid.in_fold())))
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SHARE)).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs).select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Learned languages, linked components and tokens are beyond SQL; tests hold the stages and the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
