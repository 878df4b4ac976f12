"""Queries of this subpackage: each applies an operator, with its production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, importance, jaccard_join, langid, licences, packing, perspective, secrets, topk, url_filter, warc, whitening
from .oracle import ORACLE_SQL
from .shared import fresh_path

#: PACKING_RANKS has the vocabulary of byte_bpe_50k.json.
MULTI_RANKS, PACKING_RANKS = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN
    decoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern, wanted=("n_tokens", "ids_sha256", "decoded"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_RANKS), public_tokenizers.PATTERN)


#: Pieces, documents and attention cost of a sequence of packing_three_capacities; each of them closes sequences there.
SHORT_PIECE, MOST_DOCUMENTS, MOST_ATTENTION = 512, 6, 600_000


def packing_three_capacities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op 2 with shorter pieces and all three capacities in force."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_RANKS), public_tokenizers.PATTERN, SHORT_PIECE)
    return packing.pack(pieces, 2048, MOST_DOCUMENTS, MOST_ATTENTION).withColumnRenamed("key", "doc_id")


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.in_fold()
    model = langid.train(docs.where(~held_out))
    return langid.predict(docs, model).select("doc_id", langid.in_fold().alias("held_out"), "lang_pred", "score", F.array_join(F.map_keys("mixture"), " ").alias("languages"))


def op4_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = F.array_join(F.transform("mask", lambda x: F.concat_ws(":", x["begin"].cast("string"), x["end"].cast("string"))), ",")
    return perspective.rotate(table(spark, sf_dir, "conversations")).withColumn("mask", mask)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(table(spark, sf_dir, "documents"))


def op6_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.recognise(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read_archive(spark, path, blocks=False))
    page = F.regexp_extract(F.decode("metadata.block", "utf-8"), r"pageId: (-?\d+)", 1).try_cast("long")
    refers = F.regexp_extract("capture.refers_to", r"<urn:capture:(-?\d+):", 1).try_cast("long")
    rows = captures.select(
        page.alias("page_id"), "capture.payload_bytes", F.regexp_replace("capture.payload_digest", "^sha1:", "").alias("payload_digest"),
        "capture.record_type", refers.alias("refers_to"), F.col("capture.digest_ok").alias("payload_ok"), F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))).alias("copy"),
    )
    return rows.drop("copy")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The rules of op 13.
URL_RULES = [
    url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"), url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"), url_filter.Rule("block", "com", "/de/"),
]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_best_fit_packing, op3_language_mixture, op4_perspective_rotation, op5_exact_dedup, op6_licence_rules, op7_ngram_jaccard_join, op8_secret_scan, op9_warc, op10_exact_top_k, op11_embedding_whitening, op12_importance_resampling, op13_url_filter, packing_three_capacities, pipeline)}

__all__ = ["ORACLE_SQL", "QUERIES"]
