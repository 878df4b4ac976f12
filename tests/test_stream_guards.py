"""Stateful guards against their batch twins, over several batches and restarts."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimlake.operators import corpus
from claimlake.streaming import guards

START = datetime.datetime(2024, 3, 1, 22)


@pytest.fixture(scope="module")
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    guards.use_state_store(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def run(spark, make, folder, tmp_path, name, schema=guards.COSTS):
    """What one more run of the query adds."""
    stream = make(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder))
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-c")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(tmp_path / name))


def rows_of(seed, n, sessions=4):
    rng = random.Random(seed)
    at, rows = START, []
    for i in range(n):
        at += datetime.timedelta(seconds=rng.choice([0, 1, 30, 250, 299.9996, 300, 900, 7000]))
        rows.append((i, at, rng.choice([*range(sessions), None]), rng.choice([0.01, 0.05, 0.000001, None])))
    return rows


@pytest.mark.parametrize("halt", [True, False])
def test_costs_equal_the_batch_twin_across_restarts(spark, store, tmp_path, halt):
    rows, folder = rows_of(1, 90), str(tmp_path / "log")
    parts = [rows[:40], rows[40:41], rows[41:90]]
    for i, part in enumerate(parts):  # each run is a new start of the query
        spark.createDataFrame(part, guards.COSTS).coalesce(1).write.mode("append").parquet(folder)
        got = run(spark, lambda log: guards.cost_guard(log, 0.3, 0.5, halt), folder, tmp_path, "costs")
        assert got.count() == sum(map(len, parts[: i + 1]))
    columns = ["event_id", "session", "session_total", "daily_total", "remaining", "halted"]
    want = corpus.cost_guard(spark.createDataFrame(rows, guards.COSTS), 0.3, 0.5, halt).select(columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.where("halted").count() > 5 if halt else got.where("halted").count() == 0


def test_stall_alarms_equal_the_gaps(spark, store, tmp_path):
    rows, folder = rows_of(2, 120, 3), str(tmp_path / "log")
    late = rows[:]
    random.Random(3).shuffle(late)  # all within the lateness
    end = [(1000, rows[-1][1] + datetime.timedelta(days=3), 99, 0.0)]  # moves the watermark
    for part in (late[:50], late[50:], end, [(1001, end[0][1] + datetime.timedelta(seconds=1), 99, 0.0)]):
        spark.createDataFrame(part, guards.COSTS).coalesce(1).write.mode("append").parquet(folder)
        got = run(spark, lambda log: guards.stall_alarms(log, 5, "2 days"), folder, tmp_path, "alarms")
    table = spark.createDataFrame(rows, guards.COSTS)
    before = F.lag(F.unix_micros("ts")).over(Window.partitionBy("session").orderBy("ts", "event_id"))
    gaps = corpus.stall_guard(table).withColumn("us", before).where("stalled").select("session", "us")
    last = table.groupBy("session").agg(F.max(F.unix_micros("ts")).alias("us"))
    near = lambda df: sorted((r.session is None, r.session or 0, r.us) for r in df.collect())
    found = got.where("session <> 99 or session is null").select("session", F.unix_micros("active_until").alias("us"))
    assert near(found) == near(gaps.unionByName(last)) and gaps.count() > 10
    assert got.where("stalled_at <> active_until + interval 5 minutes").count() == 0
