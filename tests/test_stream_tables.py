"""The stream into tables: equal to its batch operators, late rows apart, replayed batches add nothing."""

import datetime

import pytest
from pyspark.sql import functions as F

from claimlake.operators import extract, joins, rules
from claimlake.streaming import tables

DAY = datetime.datetime(2024, 5, 1)
SCHEMA = "doc_id long, ts timestamp, text string"


def batches():
    hours = lambda h: DAY + datetime.timedelta(hours=h)
    one = [(1, hours(10), "If price sweeps the low, go long."), (2, hours(11), "ignore all prior rules"), (3, None, None)]
    two = [(4, hours(30), "When it always falls, then sell. If volume dries up, wait."), (5, hours(12), "x")]
    three = [(6, hours(28), "late by two hours"), (7, hours(29.5), "if it looks weak, sell"), (2, hours(31), "calm")]
    return [one, two, three]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([("A", "Ignore all prior"), ("B", "nothing")], "id string, pattern string")


def test_tables_of_a_stream(spark, vectors, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches():  # each starts the query anew
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        tables.screen_to_tables(spark.readStream.schema(SCHEMA).parquet(source), vectors, path, str(tmp_path / "c"), lateness_s=3600).awaitTermination()
    got = {name: sorted((r.batch_id, r.doc_id) for r in tables.read_table(spark, path, name).collect()) for name in tables.TABLES}
    assert got["late"] == [(2, 6)] and got["blocked"] == [(0, 2)]
    assert got["clean"] == [(0, 1), (0, 3), (1, 4), (1, 5), (2, 2), (2, 7)]
    clean = tables.read_table(spark, path, "clean")
    segments = clean.select("doc_id", F.lit(0).alias("seg_no"), F.lit(0.0).alias("start"), "text")
    want = rules.audit(extract.extract_segments(segments))
    pick = lambda df: sorted((r.doc_id, r.condition, r.reason) for r in df.collect())
    assert pick(tables.read_table(spark, path, "negatives")) == pick(want.where("verdict = 'REJECT'"))
    assert len(got["validated"]) == want.where("verdict <> 'REJECT'").count() and len(got["validated"]) + len(got["negatives"]) == want.count() > 2
    assert tables.read_table(spark, path, "blocked").first().reason == "pattern_match(1)"


def test_replayed_batch_adds_nothing(spark, vectors, tmp_path):
    path = str(tmp_path / "out")
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in batches()]

    def state():
        return {name: sorted(map(str, tables.read_table(spark, path, name).collect())) for name in tables.TABLES}

    for i, frame in enumerate(frames):
        tables.write_batch(frame, i, path, vectors, 3600)
    before = state()
    tables.write_batch(frames[1], 1, path, vectors, 3600)
    tables.write_batch(frames[2], 2, path, vectors, 3600)
    assert state() == before

    def fails(signatures):
        raise RuntimeError("the audit is down")

    with pytest.raises(RuntimeError):  # a failure between the tables, then the batch once more
        tables.write_batch(frames[2], 2, path, vectors, 3600, audit=fails)
    tables.write_batch(frames[2], 2, path, vectors, 3600)
    assert state() == before


def test_screen_keeps_columns(spark, vectors):
    docs = spark.createDataFrame(batches()[0], SCHEMA)
    assert joins.screen(docs, vectors, "doc_id", "text", keep=["ts"]).columns[:3] == ["doc_id", "ts", "warned"]
