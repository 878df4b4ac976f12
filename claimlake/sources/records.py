"""Readers of claims, events, indexes, lexicons, documents and nested maps. Schemas are given, so that no file is read twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIGNATURE = "id string, condition string, action string, drawer string, drawer_confidence string, drawer_basis string, source_file string"
META = "theorist_model string, auditor_model string, auditor_verdict string, extraction_date string, bundle_id string, source_tier string, provider string"
STATUS = "status string, promoted_by string, promoted_date string, validation string"
CLAIM = f"claim_type string, source_system string, source_title string, source_url string, source_timestamp string, source_quote string, signature struct<{SIGNATURE}>, extraction_meta struct<{META}>, review struct<{STATUS}>"
EVENT = "id string, type string, content string, source string, timestamp string, reason string, metadata map<string,string>, session_date string"
INDEX = "bundle_id string, timestamp string, path string, source_url string, validated int, rejected int"
LEXICON = "id string, pattern string, category string, severity string"
QUEUE = "id string, title string, status string, url string, bundle_id string, error string, position int"
ON_ERROR = {"keep": "PERMISSIVE", "drop": "DROPMALFORMED", "raise": "FAILFAST"}


def _json(spark: SparkSession, path: str, schema: str, on_error: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("mode", ON_ERROR[on_error])
    return (reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true") if glob else reader).json(path)


def missing(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _until_bad(spark: SparkSession, path: str, schema: str, glob: str) -> DataFrame:
    """Of each file the lines before its first one that isn't a JSON object; blank lines count for nothing.

    A line's place is that of its block in the file and its number in the task that read the block, so that large files are read in parts.
    """
    rows = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    rows = rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("source_name"), place.alias("place")).where(F.trim("value") != "")
    good = F.coalesce(F.expr("schema_of_variant(try_parse_json(value)) like 'OBJECT%'"), F.lit(False))
    first = rows.where(~good).groupBy("file").agg(F.min("place").alias("first_bad"))
    kept = rows.join(first, "file", "left").where(F.col("first_bad").isNull() | (F.col("place") < F.col("first_bad")))
    return kept.select(F.from_json("value", schema).alias("c"), "source_name").select("c.*", "source_name")


def read_claims(spark: SparkSession, path: str, on_error: str = "drop", glob: str = "*.json*") -> DataFrame:
    """Claims of all files below path with the name of their file. Bad lines: kept as nulls, dropped, raised, or (abort) the end of their file."""
    if on_error == "abort":
        return _until_bad(spark, path, CLAIM, glob)
    return _json(spark, path, CLAIM, on_error, glob).withColumn("source_name", F.col("_metadata.file_name"))


def read_events(spark: SparkSession, path: str, type: str | None = None, last: int | None = None) -> DataFrame:
    """Events, of one type if given; the last n by time and id if given. Days that a filter on session_date leaves out aren't read."""
    rows = _json(spark, path, EVENT, "drop")
    rows = rows.where(F.col("type") == type) if type else rows
    return rows.orderBy(F.desc("timestamp"), F.desc("id")).limit(last) if last is not None else rows


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index rows; none if there is no file."""
    return spark.createDataFrame([], INDEX) if missing(spark, path) else _json(spark, path, INDEX, "drop")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, LEXICON, "drop")


def read_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, text, error): whole files; one without text has an error."""
    rows = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), F.when(F.trim("value") == "", "empty text").alias("error"))


def read_binary_b64(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return rows.select("path", "length", F.base64("content").alias("content"))


def ingest_dir(spark: SparkSession, path: str, recursive: bool = True, glob: str = "*") -> DataFrame:
    """(path, text, error): files as UTF-8; one that isn't gives an error row and no text."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(path)
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    return rows.select("path", F.when(valid, F.col("content").cast("string")).alias("text"), F.when(~valid, "not UTF-8").when(F.col("length") == 0, "empty text").alias("error"))


def read_queue(spark: SparkSession, path: str, root: str = "queue") -> DataFrame:
    """Rows of the list under `root` of one JSON document; a missing file is an error."""
    return spark.read.schema(f"{root} array<struct<{QUEUE}>>").option("multiLine", "true").option("mode", "FAILFAST").json(path).select(F.inline(root))


def flatten_taxonomy(groups: DataFrame) -> DataFrame:
    """(concept_id, name, drawer, term): one row a term, of groups (drawer, concepts: array of id, name, terms)."""
    concepts = groups.select("drawer", F.inline("concepts"))
    return concepts.select(F.col("id").alias("concept_id"), "name", "drawer", F.explode_outer("terms").alias("term"))


def flatten_coverage(nested: DataFrame) -> DataFrame:
    """(concept_id, source, status) of a column `matrix`, a map of concepts to maps of sources to statuses."""
    outer = nested.select(F.explode("matrix").alias("concept_id", "sources"))
    return outer.select("concept_id", F.explode("sources").alias("source", "status"))


def nest_coverage(cells: DataFrame) -> DataFrame:
    """(concept_id, sources): one row a concept, so that no row holds the whole matrix."""
    return cells.groupBy("concept_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "status")))).alias("sources"))


def source_catalog(sources: DataFrame, queue: DataFrame, files: DataFrame) -> DataFrame:
    """(source, type, tier, available, item_count, pending_count): queue rows count for queues, files for the others."""
    queued = queue.groupBy("source").agg(F.count(F.lit(1)).alias("n_queue"), F.count_if(F.col("status") == "QUEUED").alias("n_pending"))
    held = files.groupBy("source").agg(F.count(F.lit(1)).alias("n_files"))
    of_queue, zero = F.col("type") == "queue", F.lit(0).cast("long")
    items = F.coalesce(F.when(of_queue, F.col("n_queue")).otherwise(F.col("n_files")), zero)
    return sources.join(queued, "source", "left").join(held, "source", "left").select("source", "type", "tier", (items > 0).alias("available"), items.alias("item_count"), F.coalesce(F.when(of_queue, F.col("n_pending")), zero).alias("pending_count"))


def source_tier(path: Column, rules: tuple[tuple[str, tuple[str, ...]], ...], otherwise: str = "LATERAL") -> Column:
    """The tier of the first rule one of whose words the lower-case path contains."""
    low, out = F.lower(path), F.when(F.lit(False), "")
    for tier, words in rules:
        out = out.when(low.rlike("|".join(words)), tier)
    return out.otherwise(otherwise)
