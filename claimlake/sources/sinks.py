"""Writers: daily events, claims and texts by bundle, replaced tables, archives and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .records import EVENT, missing
from .shared import delete, materialise, scratch


POINTER = "version string, number long"


def append_events(events: DataFrame, path: str) -> None:
    """Appends by UTC day of the timestamp; rows of a day are brought together first, so that a day gets few files."""
    dated = events.withColumn("session_date", F.substring("timestamp", 1, 10))
    dated.repartition("session_date", F.pmod(F.hash("id"), F.lit(8))).write.mode("append").partitionBy("session_date").json(path)


def export_claims(claims: DataFrame, path: str) -> None:
    claims.withColumn("bundle", F.col("extraction_meta.bundle_id")).write.mode("append").partitionBy("bundle").json(path)


def write_bundles(bundles: DataFrame, path: str) -> None:
    """Texts (bundle_id, text) below path/text, index rows appended below path/index."""
    bundles.select("bundle_id", F.col("text").alias("value")).write.mode("append").partitionBy("bundle_id").text(f"{path}/text")
    bundles.drop("text").write.mode("append").json(f"{path}/index")


def replace_table(rows: DataFrame, path: str) -> str:
    """Writes a new version beside the old ones, then points to it; readers see the old or the new rows, never a part. One writer at a time."""
    spark, version = rows.sparkSession, f"v-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{version}")
    number = 0 if missing(spark, f"{path}/pointer") else spark.read.schema(POINTER).parquet(f"{path}/pointer").agg(F.max("number")).first()[0] + 1
    spark.range(1).select(F.lit(version).alias("version"), F.lit(number).cast("long").alias("number")).coalesce(1).write.mode("append").parquet(f"{path}/pointer")
    return version


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    version = spark.read.schema(POINTER).parquet(f"{path}/pointer").agg(F.max_by("version", F.struct("number", "version"))).first()[0]
    return spark.read.parquet(f"{path}/{version}")


def split_archive(events: DataFrame, today: str, keep_days: int) -> tuple[DataFrame, DataFrame]:
    """(live, archived) by age of session_date; days that can't be read stay."""
    old = F.coalesce(F.datediff(F.lit(today).cast("date"), F.expr("try_to_date(session_date, 'yyyy-MM-dd')")) >= keep_days, F.lit(False))
    return events.where(~old), events.where(old)


def _days(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame([], EVENT) if missing(spark, path) else spark.read.schema(EVENT).json(path)


def archive_events(spark: SparkSession, live: str, archived: str, today: str, keep_days: int) -> list[str]:
    """Moves the days of `live` (as append_events writes them) that are keep_days old or older to `archived`, and returns them.

    The days are written to the archive first, together with what it holds of them already, and leave the live folder only then: a failure between the steps loses no day, read_archived gives none of its
    rows twice, and the next run goes on. Days that can't be read as a date stay. There are as many names in the driver as days.
    """
    rows = _days(spark, live)
    old = split_archive(rows, today, keep_days)[1]
    days = sorted(str(r[0]) for r in old.select("session_date").distinct().collect())
    if days:
        with scratch(spark):
            held = _days(spark, archived).where(F.col("session_date").isin(days))
            key = F.to_json(F.struct(*held.columns))
            both = materialise(held.unionByName(old).withColumn("__key", key).dropDuplicates(["__key"]).drop("__key"), "archive")
            both.repartition("session_date", F.pmod(F.hash("id"), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session_date").json(archived)
        for day in days:
            delete(spark, f"{live.rstrip('/')}/session_date={day}")
    return days


def read_archived(spark: SparkSession, live: str, archived: str) -> DataFrame:
    """Events of both folders with the column part; rows of a day that both hold count once."""
    here, there = _days(spark, live), _days(spark, archived)
    key = F.to_json(F.struct(*there.columns))
    keyed = lambda df: df.withColumn("__key", key)
    both = there.select("session_date").distinct().join(here.select("session_date").distinct(), "session_date")  # days between the steps of a move
    again = keyed(here.join(both, "session_date", "left_semi")).join(keyed(there).select("__key"), "__key", "left_anti").drop("__key")
    alone = here.join(both, here["session_date"].eqNullSafe(both["session_date"]), "left_anti")
    part = lambda df, name: df.withColumn("part", F.lit(name))
    return part(there, "archived").unionByName(part(alone, "live")).unionByName(part(again, "live"))


def incidents(flagged: DataFrame, id_col: str, text_col: str, at: str) -> DataFrame:
    """Event rows for blocked documents: reason, and the first 500 characters of the text."""
    return flagged.where("blocked").select(F.col(id_col).cast("string").alias("id"), F.lit("INCIDENT").alias("type"), F.substring(text_col, 1, 500).alias("content"), F.lit(at).alias("timestamp"), "reason")


def stage_log(rows: DataFrame, stage: str, text_col: str = "text") -> DataFrame:
    """(stage, n, chars, preview) of the rows of a stage; the preview is of the smallest text."""
    return rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("chars"), F.min(F.substring(text_col, 1, 1000)).alias("preview")).select(F.lit(stage).alias("stage"), "*")


def write_logged(rows: DataFrame, path: str, stage: str, text_col: str = "text") -> dict:
    """Writes rows as Parquet and returns their stage_log, observed in the same pass."""
    seen = Observation()
    watched = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("chars"), F.min(F.substring(text_col, 1, 1000)).alias("preview"))
    watched.write.mode("overwrite").parquet(path)
    return {"stage": stage, **seen.get}


def to_json(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def to_markdown(rows: DataFrame) -> DataFrame:
    """A line of a Markdown table for each row; the header is for the caller to write first."""
    cells = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("—")), F.lit("|"), F.lit("\\|")) for c in rows.columns]
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))
