"""Streams over append-only logs (event_id, ts, session, cost); each has a batch twin in operators.corpus. Late by over a day: dropped."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import coverage, rules
from ..operators.joins import pattern_match

LATENESS = "1 day"


def daily_counts(log: DataFrame, trigger: int = 25) -> DataFrame:
    """(day, n, compress) by UTC day, updated with each batch."""
    counted = log.withWatermark("ts", LATENESS).groupBy(F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.to_date("window.start").alias("day"), "n", (F.col("n") >= trigger).alias("compress"))


def running_cost(log: DataFrame, limit: float) -> DataFrame:
    """(session, total, halted) after each batch; a session stays halted once its total has reached the limit."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total, halted = state.get if state.exists else (0.0, False)
        for batch in batches:
            total += float(batch["cost"].fillna(0).sum())
        halted = halted or round(total, 6) >= limit
        state.update((total, halted))
        yield pd.DataFrame({"session": [key[0]], "total": [round(total, 6)], "halted": [halted]})

    return log.groupBy("session").applyInPandasWithState(update, "session long, total double, halted boolean", "total double, halted boolean", "update", GroupStateTimeout.NoTimeout)


def stalls(log: DataFrame, gap: str = "5 minutes") -> DataFrame:
    """(session, active_from, stalled_at, n): spans of activity that ended in a gap; given out once the watermark has passed."""
    spans = log.withWatermark("ts", LATENESS).groupBy("session", F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("n"))
    return spans.select("session", F.col("session_window.start").alias("active_from"), F.col("session_window.end").alias("stalled_at"), "n")


def first_logic(signatures: DataFrame) -> DataFrame:
    """Signatures (doc_id, ts, condition, action), the first of equal logic of a document only."""
    key = F.concat_ws("|", F.trim(F.lower("condition")), F.trim(F.lower("action")))
    return signatures.withColumn("key", key).withWatermark("ts", LATENESS).dropDuplicatesWithinWatermark(["doc_id", "key"])


def screened(docs: DataFrame, vectors: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Matches of attack patterns in a stream of documents, without state."""
    return pattern_match(docs, vectors, id_col, text_col, distinct=False)


def audited(signatures: DataFrame, **lexicons) -> DataFrame:
    return rules.audit(signatures, **lexicons)


def coverage_upgrades(observations: DataFrame) -> DataFrame:
    """(concept_id, source, rank, status) in update mode: the highest status seen so far."""
    best = observations.groupBy("concept_id", "source").agg(F.max(coverage.rank_of(F.col("status"))).alias("rank"))
    return best.withColumn("status", F.element_at(F.array(*map(F.lit, coverage.STATUSES)), F.col("rank").cast("int")))
