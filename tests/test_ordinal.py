"""Numbers, previous values, running sums and rolling means over parts, against plain loops and with one group that holds most rows."""

import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimlake.operators import corpus, ordinal


@pytest.fixture(scope="module", autouse=True)
def parts(spark):
    """Small tables stay in several parts."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 == 8, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    return spark.range(6000).select(key.alias("g"), (F.col("id") * 7919 % 6000).alias("at"), F.when(F.col("id") % 11 > 0, F.col("id") % 13).alias("v")).repartition(5)


def test_previous_and_number_equal_one_window(spark, rows):
    by = Window.partitionBy("g").orderBy("at")
    got = ordinal.with_previous(rows, "g", ["at"], "v", "before", "n")
    want = rows.withColumns({"before": F.lag("v").over(by), "n": F.row_number().over(by)})
    assert sorted(map(str, got.select("g", "at", "before", "n").collect())) == sorted(map(str, want.select("g", "at", "before", "n").collect()))
    assert ordinal.with_previous(rows.limit(0), "g", ["at"], "v", "before", "n").count() == 0
    dealt = ordinal._dealt(rows, "g", ["at"])
    share = dealt.groupBy("__part").count().agg(F.max("count")).first()[0]
    assert share < 0.4 * rows.count()  # though a key holds 70 % of all rows


@pytest.mark.parametrize("size, keep", [(100, 6000), (100, 150), (3, 10), (50, 1), (1, 30), (9, 0)])
def test_rolling_mean_equals_one_window(spark, rows, size, keep):
    some = rows.where(F.col("at") < keep)
    got = ordinal.rolling_mean(some, ["at"], F.col("v"), size, "m").select("at", F.round("m", 9).alias("m"))
    want = some.select("at", F.round(F.avg("v").over(Window.orderBy("at").rowsBetween(1 - size, 0)), 9).alias("m"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_drift_and_silence(spark):
    start = datetime.datetime(2024, 1, 1)
    verdicts = spark.createDataFrame([(i, start + datetime.timedelta(hours=i), "REJECT" if i < 110 and i % 4 == 0 else "NO_FALSIFICATION_FOUND") for i in range(260)], "id int, ts timestamp, verdict string")
    got = {r.id: r for r in corpus.drift_alert(verdicts, ["id"]).collect()}
    assert not any(got[i].drifting for i in range(99)) and len(got) == 260
    for i in range(99, 260):
        share = sum(j < 110 and j % 4 == 0 for j in range(i - 99, i + 1)) / 100
        assert abs(got[i].share - share) < 1e-12 and got[i].drifting == (share < 0.05)
    last = start + datetime.timedelta(hours=108)
    silent = lambda hours: corpus.silent_rejections(verdicts, "ts", str(last + datetime.timedelta(hours=hours))).first()
    assert silent(23).silent is False and silent(24).silent is True and silent(1).last_rejection == last
    assert corpus.silent_rejections(verdicts.limit(0), "ts", "2024-01-01").first().silent is True


def test_guards_keep_other_columns(spark):
    log = spark.createDataFrame([(i, datetime.datetime(2024, 1, 1, 0, 0, i), i % 2, 0.1, f"n{i}") for i in range(6)], "event_id int, ts timestamp, session int, cost double, note string")
    for out in (corpus.turn_guard(log), corpus.stall_guard(log), corpus.cost_guard(log, 1.0, 1.0)):
        assert {(r.event_id, r.note) for r in out.collect()} == {(i, f"n{i}") for i in range(6)} and set(log.columns) <= set(out.columns)
