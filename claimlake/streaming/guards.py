"""Guards that keep state over a stream of log rows (event_id, ts, session, cost): running costs event by event, and alarms for stalls.

Sums and times live in the state store, so that a restart goes on where the query ended; they need the RocksDB store (`use_state_store`). Both equal their batch twins in operators.corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .logs import LATENESS

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COSTS = "event_id long, ts timestamp, session long, cost double"


def use_state_store(spark: SparkSession) -> None:
    """Stateful processors need a store with column families."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class _Total(StatefulProcessor):
    """Adds a running total, in millionths, to the rows of a key: those of a batch in the order of time and id, after all of the batches before."""

    def __init__(self, column: str):
        self.column = column

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "micros long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        held = self.total.get()
        batch[self.column] = (held[0] if held else 0) + batch["micros"].cumsum()
        self.total.update((int(batch[self.column].iloc[-1]),))
        yield batch

    def close(self) -> None:
        pass


class _Halt(StatefulProcessor):
    """Session totals after each row, and a halt that stays once the session or its day has reached its limit."""

    def __init__(self, session_limit: float, daily_limit: float, halt: bool):
        self.limits, self.halt = (session_limit, daily_limit), halt

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("session", "micros long, halted boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        micros, halted = self.state.get() or (0, False)
        total = micros + batch["micros"].cumsum()
        session, daily = total / 1e6, batch["daily_micros"] / 1e6
        over = ((session >= self.limits[0]) | (daily >= self.limits[1])) & self.halt
        stays = over.cummax() | halted
        self.state.update((int(total.iloc[-1]), bool(stays.iloc[-1])))
        remaining = (self.limits[0] - session).round(6).clip(lower=0.0)
        yield pd.DataFrame({"event_id": batch["event_id"], "ts": batch["ts"], "session": batch["session"], "session_total": session, "daily_total": daily, "remaining": remaining, "halted": stays})

    def close(self) -> None:
        pass


def cost_guard(log: DataFrame, session_limit: float, daily_limit: float, halt: bool = True) -> DataFrame:
    """(event_id, ts, session, session_total, daily_total, remaining, halted) of each event, in append mode.

    Rows of a batch count in the order of time and id, batches in that of their arrival; for a log that is appended to in order, which this is for, each row is that of the batch twin. Two states follow one another:
    that of the day over all sessions, and that of the session. A day's rows of one batch are in one task, so the size of batches is what bounds it.
    """
    rows = log.select("event_id", "ts", "session", F.to_date("ts").alias("day"), F.round(F.coalesce("cost", F.lit(0.0)) * 1e6).cast("long").alias("micros"))
    # a null session is one of its own
    rows = rows.withColumn("known", F.coalesce(F.col("session").cast("string"), F.lit("")))
    daily = rows.groupBy("day").transformWithStateInPandas(_Total("daily_micros"), "event_id long, ts timestamp, session long, day date, micros long, known string, daily_micros long", "append", "none")
    schema = "event_id long, ts timestamp, session long, session_total double, daily_total double, remaining double, halted boolean"
    return daily.groupBy("known").transformWithStateInPandas(_Halt(session_limit, daily_limit, halt), schema, "append", "none")


class _Stall(StatefulProcessor):
    """Times of a session that may still be followed within the gap; a timer of event time tells when the first of them can't."""

    def __init__(self, gap_s: float):
        self.gap_s, self.gap_us = gap_s, int(round(gap_s * 1_000_000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "times array<long>")

    def _settle(self, key, times: list[int], watermark_ms: int) -> pd.DataFrame | None:
        """Alarms of the times whose gap the watermark has passed; those left open go to the state, with a timer for the first."""
        times.sort()
        alarms = []
        while times and times[0] + self.gap_us <= watermark_ms * 1000:
            if len(times) == 1 or round((times[1] - times[0]) / 1e6, 3) >= self.gap_s:
                alarms.append(times[0])
            times.pop(0)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if times:
            self.open.update((times,))
            self.handle.registerTimer(-(-(times[0] + self.gap_us) // 1000))
        else:
            self.open.clear()
        if not alarms:
            return None
        until = pd.to_datetime(pd.Series(alarms), unit="us")
        return pd.DataFrame({"session": [key[0]] * len(alarms), "active_until": until, "stalled_at": until + pd.Timedelta(microseconds=self.gap_us)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.open.get()
        times = list(held[0]) if held else []
        for batch in rows:
            times += batch["us"].tolist()
        found = self._settle(key, times, timerValues.getCurrentWatermarkInMs())
        if found is not None:
            yield found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.open.get()
        found = self._settle(key, list(held[0]) if held else [], timerValues.getCurrentWatermarkInMs())
        if found is not None:
            yield found

    def close(self) -> None:
        pass


def stall_alarms(log: DataFrame, minutes: float = 5, lateness: str = LATENESS) -> DataFrame:
    """(session, active_until, stalled_at): an alarm for each row of a session that no other follows within the gap, given once the watermark has passed it.

    Rows may come in any order within the lateness. The state of a session holds the times of its last gap and lateness.
    """
    rows = log.select("session", "ts", F.unix_micros("ts").alias("us")).withWatermark("ts", lateness)
    return rows.groupBy("session").transformWithStateInPandas(_Stall(minutes * 60), "session long, active_until timestamp, stalled_at timestamp", "append", "eventTime")
