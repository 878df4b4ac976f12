"""A stream of documents screened, extracted and audited into tables, a folder of each batch in each of them.

A batch that is run again, after a failure between its tables, writes the same folders once more: nothing is added twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import rules
from ..operators.extract import extract_segments
from ..operators.joins import screen
from ..sources.records import missing
from ..sources.shared import materialise, scratch

TABLES = ("clean", "blocked", "validated", "negatives", "late")


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All batches of one of TABLES; the column batch_id tells them apart."""
    return spark.read.parquet(f"{path}/{name}")


def _seen_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The latest time (microseconds) of the batches before this one; the same for a batch that is run again."""
    if missing(spark, f"{path}/progress"):
        return None
    rows = spark.read.schema("latest long, batch_id long").parquet(f"{path}/progress")
    return rows.where(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]


def write_batch(batch: DataFrame, batch_id: int, path: str, vectors: DataFrame, lateness_s: float, audit: Callable[[DataFrame], DataFrame] = rules.audit) -> None:
    """One batch of documents (doc_id, ts, text) to its folders.

    late: rows whose time lies more than the lateness before the latest of earlier batches; blocked: rows that the screen blocks, with its reason; clean: all others. The signatures of
    clean documents are audited: validated, and negatives with the reason. Rows without a time are never late.
    """
    spark = batch.sparkSession

    def write(rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")

    latest = _seen_before(spark, path, batch_id)
    us = F.unix_micros("ts")
    late = F.lit(False) if latest is None else F.coalesce(us < latest - int(lateness_s * 1e6), F.lit(False))
    with scratch(spark):
        told = screen(batch.where(~late), vectors, "doc_id", "text", keep=["ts", "text"])
        screened = materialise(told.select("doc_id", "ts", "text", "blocked", "reason"), "screened")
        write(batch.where(late), "late")
        write(screened.where("blocked").drop("blocked"), "blocked")
        clean = screened.where("not blocked").drop("blocked", "reason")
        write(clean, "clean")
        segments = clean.select("doc_id", F.lit(0).alias("seg_no"), F.lit(0.0).alias("start"), "text")
        validated, rejected = rules.split_verdicts(audit(extract_segments(segments)))
        write(validated, "validated")
        write(rejected.select("doc_id", "id", "condition", "action", "reason", "citation"), "negatives")
        # the last table: a batch that fails before leaves no progress
        write(batch.agg(F.max(us).alias("latest")), "progress")


def screen_to_tables(docs: DataFrame, vectors: DataFrame, path: str, checkpoint: str, lateness_s: float = 86_400, audit: Callable[[DataFrame], DataFrame] = rules.audit, **trigger) -> StreamingQuery:
    """Starts the stream of documents (doc_id, ts, text) into the tables below path."""
    run = lambda batch, batch_id: write_batch(batch, batch_id, path, vectors, lateness_s, audit)
    return docs.select("doc_id", "ts", "text").writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
