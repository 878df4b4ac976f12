import pytest
from pyspark.sql import functions as F

from claimlake.streaming import logs

SCHEMA = "event_id long, ts timestamp, session long, cost double"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = events.select(F.col("event_id").cast("long"), F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("long").alias("session"), F.round(F.abs("value") / 1000, 6).alias("cost"))
    rows.coalesce(1).write.parquet(path, mode="overwrite")
    return path


def drained(spark, df, mode, tmp_path, name):
    df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


def test_daily_counts(spark, log, tmp_path):
    got = drained(spark, logs.daily_counts(spark.readStream.schema(SCHEMA).parquet(log)), "update", tmp_path, "daily")
    want = spark.read.parquet(log).groupBy(F.to_date("ts").alias("day")).count()
    assert {(r.day, r.n) for r in got.collect()} == {(r.day, r["count"]) for r in want.collect()}


def test_running_cost(spark, log, tmp_path):
    got = drained(spark, logs.running_cost(spark.readStream.schema(SCHEMA).parquet(log), 0.5), "update", tmp_path, "cost")
    want = {r.session: r.total for r in spark.read.parquet(log).groupBy("session").agg(F.sum("cost").alias("total")).collect()}
    rows = got.collect()
    assert len(rows) == len(want) and all(abs(r.total - want[r.session]) < 1e-5 and r.halted == (round(r.total, 6) >= 0.5) for r in rows)


def test_first_logic(spark, log, tmp_path):
    stream = spark.readStream.schema(SCHEMA).parquet(log).select(F.col("session").alias("doc_id"), "ts", (F.col("event_id") % 2).cast("string").alias("condition"), F.lit("x").alias("action"))
    got = drained(spark, logs.first_logic(stream), "append", tmp_path, "logic")
    assert got.count() == spark.read.parquet(log).select("session", F.col("event_id") % 2).distinct().count()


def test_stalls(spark, log, tmp_path):
    got = drained(spark, logs.stalls(spark.readStream.schema(SCHEMA).parquet(log)), "append", tmp_path, "stalls")
    assert 0 < got.agg(F.sum("n")).first()[0] <= spark.read.parquet(log).count()


def test_coverage(spark, tmp_path):
    spark.createDataFrame([("c", "s", "ABSENT"), ("c", "s", "FOUND"), ("d", "s", "PENDING")], "concept_id string, source string, status string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("concept_id string, source string, status string").parquet(str(tmp_path / "in"))
    got = drained(spark, logs.coverage_upgrades(stream), "update", tmp_path, "cover")
    assert {(r.concept_id, r.status) for r in got.collect()} == {("c", "FOUND"), ("d", "PENDING")}
