"""Between texts and models: transcripts in, prompts out, answers parsed, claims made."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fmt_ts, parse_llm_array, unfence

ANSWER = "struct<`if`:string,`then`:string,timestamp:string,source_quote:string,confidence:string,drawer:string,drawer_confidence:string,drawer_basis:string>"


def normalize_transcript(payloads: DataFrame) -> DataFrame:
    """(doc_id, seg_no, start, text) of payloads (doc_id, payload): content is a text, a list of texts, or a list of timed objects.

    Times are milliseconds. Blank timed texts are dropped; payloads that aren't JSON or have no content have no segments.
    """
    rows = payloads.select("doc_id", F.expr("variant_get(try_parse_json(payload), '$.content')").alias("content"))
    items = F.expr("case when schema_of_variant(content) like 'ARRAY%' then cast(content as array<variant>) when content is not null then array(content) end")
    rows = rows.select("doc_id", F.posexplode(items).alias("at", "item"), F.expr("schema_of_variant(content) like 'ARRAY%'").alias("listed"))
    timed = F.expr("schema_of_variant(item) like 'OBJECT%'")
    start = F.when(timed, F.coalesce(F.expr("try_variant_get(item, '$.offset', 'double')"), F.lit(0.0)) / 1000).otherwise(0.0)
    text = F.when(timed, F.expr("try_variant_get(item, '$.text', 'string')")).otherwise(F.expr("try_variant_get(item, '$', 'string')"))
    out = rows.select("doc_id", "at", start.alias("start"), F.when(F.col("listed"), F.btrim(text)).otherwise(text).alias("text"), timed.alias("timed")).where(~F.col("timed") | (F.col("text") != ""))
    return out.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("at")) - 1).alias("seg_no"), "start", "text")


def format_transcript(segments: DataFrame, title: Column, by: str = "doc_id") -> DataFrame:
    """(by, prompt): the title of a transcript, then a line for each segment (by, seg_no, start, text) with its second; title is of a row and the same for all of a transcript."""
    line = F.format_string("[%.1fs] %s", F.col("start").cast("double"), F.coalesce("text", F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("seg_no", line.alias("line"))))
    body = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    return segments.groupBy(by).agg(F.concat(F.first(F.coalesce(title, F.lit("unknown"))), F.lit("\n\n"), body).alias("prompt"))


def timed_lines(segments: DataFrame, by: str = "doc_id") -> DataFrame:
    """(by, content): a line [MM:SS] text for each segment (by, seg_no, start, text) that has text."""
    whole = F.floor("start").cast("long")
    line = F.format_string("[%02d:%02d] %s", F.floor(whole / 60), whole % 60, F.btrim("text"))
    kept = segments.where(F.btrim("text") != "")
    ordered = F.array_sort(F.collect_list(F.struct("seg_no", line.alias("line"))))
    return kept.groupBy(by).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("content"))


def timestamp_range(segments: DataFrame, docs: DataFrame, by: str = "doc_id") -> DataFrame:
    """(by, span): M:SS of a document's first and last segment, 0:00-0:00 for one without any."""
    zero = F.lit(0.0)
    ends = segments.groupBy(by).agg(F.min_by("start", "seg_no").alias("a"), F.max_by("start", "seg_no").alias("b"))
    return docs.select(by).join(ends, by, "left").select(by, F.concat_ws("-", fmt_ts(F.coalesce("a", zero)), fmt_ts(F.coalesce("b", zero))).alias("span"))


def format_chunks(chunks: DataFrame) -> DataFrame:
    """(doc_id, prompt): all chunks of a document, each below its provenance, tier and file."""
    block = F.concat(F.format_string("[%s] [%s] %s\n", "provenance", "source_tier", "source_file"), "text", F.lit("\n\n"))
    ordered = F.array_sort(F.collect_list(F.struct("chunk_num", block.alias("block"))))
    return chunks.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["block"]), "").alias("prompt"))


def format_visual(described: DataFrame, page_text: DataFrame) -> DataFrame:
    """(doc_id, prompt): described pages (doc_id, page_num, description) with their text if there is any, a rule between pages."""
    met = described.join(page_text.select("doc_id", "page_num", "text"), ["doc_id", "page_num"], "left")
    head = F.when(F.col("page_num").isNull(), "VISUAL CONTENT:\n").otherwise(F.format_string("VISUAL CONTENT (page %d):\n", "page_num"))
    seen = F.when(F.coalesce("text", F.lit("")) != "", F.concat(F.lit("PAGE TEXT:\n"), "text", F.lit("\n"))).otherwise("")
    ordered = F.array_sort(F.collect_list(F.struct("page_num", F.concat(head, seen, "description").alias("block"))))
    return met.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["block"]), "\n---\n\n").alias("prompt"))


def build_prompts(chunks: DataFrame, task: str) -> DataFrame:
    """Adds prompt: the template for spans of time if a chunk has start and end, else that for excerpts."""
    timed = F.concat(F.format_string("TRANSCRIPT SEGMENT [%.0fs - %.0fs]:\n\n", "start", "end"), "text", F.lit(f"\n\n{task}"))
    section = F.when(F.coalesce("section", F.lit("")) != "", F.format_string("[Section: %s]\n\n", "section")).otherwise("")
    excerpt = F.concat(F.lit("DOCUMENT EXCERPT:\n\n"), section, "text", F.lit(f"\n\n{task}"))
    return chunks.withColumn("prompt", F.when(F.col("start").isNotNull() & F.col("end").isNotNull(), timed).otherwise(excerpt))


def concept_prompts(docs: DataFrame, concepts: DataFrame, task: str, most_chars: int = 15000) -> DataFrame:
    """(doc_id, drawer, prompt): a prompt for each document and drawer, with the drawer's concepts and the head of the document's text.

    A concept (concept_id, ord, drawer, name, definition, terms) is a line with 200 characters of its definition and its first five terms.
    Concepts are a lexicon: each drawer's list is one row.
    """
    from .joins import lookup

    line = F.concat(F.lit("- "), "concept_id", F.lit(": "), "name", F.lit(" - "), F.substring(F.coalesce("definition", F.lit("")), 1, 200), F.lit(" (terms: "), F.array_join(F.slice("terms", 1, 5), ", "), F.lit(")"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("line")))), lambda x: x["line"])
    lists = lookup(concepts.groupBy("drawer").agg(F.array_join(ordered, "\n").alias("list")))
    head = F.concat(F.lit("CONCEPTS:\n"), "list", F.lit("\n\nCONTENT:\n"), F.substring("text", 1, most_chars), F.lit(f"\n\n{task}"))
    return docs.join(lists, F.col("drawer").isNotNull()).select("doc_id", "drawer", head.alias("prompt"))


ANSWERED = "prompt_hash string, response string, error string"


def _asked(responder: Callable[[list[str]], list[str | None]], batch: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for begin in range(0, len(frame), batch):
                part = frame.iloc[begin : begin + batch]
                told = _answers(responder, part["prompt"].tolist())
                yield pd.DataFrame({"prompt_hash": part["prompt_hash"].tolist(), "response": [a for a, _ in told], "error": [e for _, e in told]})

    return run


def _answers(responder: Callable[[list[str]], list[str | None]], prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each prompt; where a batch fails its prompts are asked one by one, so that one of them doesn't cost the others."""
    try:
        found = list(responder(prompts))
        if len(found) != len(prompts):
            raise ValueError(f"{len(found)} answers to {len(prompts)} prompts")
        return [(x, None if x is not None else "no answer") for x in found]
    except Exception as e:  # whatever a responder raises becomes a row
        if len(prompts) == 1:
            return [(None, f"{type(e).__name__}: {e}"[:500])]
        return [x for p in prompts for x in _answers(responder, [p])]


def ask(prompts: DataFrame, responder: Callable[[list[str]], list[str | None]], answers: str, batch: int = 32, wave: int = 10_000) -> DataFrame:
    """Answers (prompt_hash, response, error) of all prompts (prompt), by a user's function from a list of prompts to one of answers.

    Each distinct prompt is asked once: answers are appended to the table at `answers`, below which earlier ones aren't asked for again, neither by a later run nor after a failure. Prompts
    go in waves of about `wave`, each written when it ends, and within one in tasks of some batches, four for each core at most, so that a lost executor costs a task for each of its cores. An answer that failed has an
    error, and is asked for again by the next run.
    """
    from ..sources.records import missing
    from ..sources.shared import materialise, scratch, scratch_path

    spark = prompts.sparkSession

    def recorded() -> DataFrame:
        return spark.createDataFrame([], ANSWERED) if missing(spark, answers) else spark.read.schema(ANSWERED).parquet(answers)

    with scratch(spark):
        hashed = prompts.where("prompt is not null").select(F.sha2("prompt", 256).alias("prompt_hash"), "prompt").dropDuplicates(["prompt_hash"])
        todo = materialise(hashed.join(recorded().where("response is not null").select("prompt_hash"), "prompt_hash", "left_anti"), "prompts")
        waves = -(-todo.count() // wave)
        tasks = 4 * spark.sparkContext.defaultParallelism  # a task for each batch costs more than its answers
        # a folder for each wave, so that none reads the prompts of the others
        path = scratch_path(spark, "waves")
        numbered = todo.withColumn("wave", F.pmod(F.xxhash64("prompt_hash"), F.lit(max(1, waves))).cast("int"))
        numbered.repartition(max(1, min(waves, 1_000)), "wave").write.partitionBy("wave").parquet(path)
        for i in range(waves):
            if not missing(spark, f"{path}/wave={i}"):
                part = spark.read.schema(todo.schema).parquet(f"{path}/wave={i}")
                part.repartition(max(1, min(min(wave, 10_000) // batch, tasks))).mapInPandas(_asked(responder, batch), ANSWERED).write.mode("append").parquet(answers)
    return recorded()


def with_model_responses(prompts: DataFrame, responses: DataFrame | Callable[[list[str]], list[str | None]], answers: str | None = None, **asking) -> DataFrame:
    """Joins answers (prompt_hash, response) by the SHA-256 of the prompt; a prompt without one has null.

    responses: a table of recorded answers, or a responder that `ask` uses, with the folder of its answers.
    """
    if callable(responses):
        if answers is None:
            raise ValueError("a responder needs a folder for its answers")
        responses = ask(prompts, responses, answers, **asking)
    recorded = responses.groupBy("prompt_hash").agg(F.min("response").alias("response"))
    return prompts.withColumn("prompt_hash", F.sha2("prompt", 256)).join(recorded, "prompt_hash", "left")


def parse_llm_lines(c: Column, need: bool = True) -> Column:
    """Objects of an answer with one JSON object a line; lines without a concept only if not needed."""
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x.startswith("{"))
    found = F.transform(lines, lambda x: F.from_json(x, "struct<concept_id:string,status:string,quote:string>"))
    return F.filter(found, lambda x: x["concept_id"].isNotNull() if need else x.isNotNull())


def parse_llm_object(c: Column, schema: str) -> Column:
    """struct(value, error, raw): the object of the first fence, or the first 500 characters of what can't be parsed."""
    value = F.from_json(unfence(c), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    good = F.try_parse_json(unfence(c)).isNotNull()
    return F.struct(F.when(good, value).alias("value"), F.when(~good, "invalid JSON").alias("error"), F.when(~good, F.substring(c, 1, 500)).alias("raw"))


def parse_response(c: Column) -> Column:
    """struct(text, prompt_tokens, completion_tokens) of a provider's answer: its text blocks in order, its usage or 0."""
    got = F.from_json(c, "struct<content:array<struct<type:string,text:string>>,usage:struct<input_tokens:bigint,output_tokens:bigint>>")
    text = F.array_join(F.transform(F.filter(got["content"], lambda b: b["type"] == "text"), lambda b: b["text"]), "")
    usage = lambda n: F.coalesce(got["usage"][n], F.lit(0).cast("long"))
    return F.struct(F.coalesce(text, F.lit("")).alias("text"), usage("input_tokens").alias("prompt_tokens"), usage("output_tokens").alias("completion_tokens"))


def signatures_from_llm(answers: DataFrame) -> DataFrame:
    """Signatures of answers (doc_id, chunk_no, response): the first of equal logic in a document stays; ids run over it."""
    rows = answers.select("doc_id", "chunk_no", F.posexplode(parse_llm_array(F.col("response"), ANSWER)).alias("at", "s")).select("doc_id", "chunk_no", "at", "s.*")
    blank = lambda n: F.coalesce(F.col(n), F.lit(""))
    rows = rows.withColumns({"if": blank("if"), "then": blank("then")})
    key = F.concat_ws("|", F.trim(F.lower("if")), F.trim(F.lower("then")))
    place = F.struct("chunk_no", "at")
    kept = rows.groupBy("doc_id", key.alias("key")).agg(F.min(place).alias("place"), F.min_by(F.struct("*"), place).alias("s"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("place"))
    return kept.select(
        "doc_id", F.format_string("S-%03d", number).alias("id"), F.concat(F.lit("IF "), "s.if").alias("condition"), F.concat(F.lit("THEN "), "s.then").alias("action"),
        F.coalesce("s.timestamp", F.col("s.chunk_no").cast("string")).alias("source_timestamp"), F.substring(F.coalesce("s.source_quote", F.lit("")), 1, 200).alias("source_quote"),
        F.coalesce("s.confidence", F.lit("EXPLICIT")).alias("confidence"), F.col("s.drawer").alias("drawer"), F.coalesce("s.drawer_confidence", F.lit("inferred")).alias("drawer_confidence"), F.coalesce("s.drawer_basis", F.lit("")).alias("drawer_basis"),
    )


def bundle_id(at: Column, salt: Column) -> Column:
    """B-date-time in UTC with a hash of the source, so that two bundles of a second differ."""
    return F.concat(F.lit("B-"), F.date_format(at, "yyyyMMdd-HHmmss"), F.lit("-"), F.substring(F.sha2(salt.cast("string"), 256), 1, 8))


def to_claims(signatures: DataFrame, system: str, extracted_at: str) -> DataFrame:
    """Nested claims of flat signatures; absent columns and nulls take the defaults."""
    has = set(signatures.columns)
    col = lambda n, default=None: (F.coalesce(F.col(n).cast("string"), F.lit(default)) if n in has else F.lit(default)).cast("string").alias(n)
    null = F.lit(None).cast("string")
    signature = F.struct(col("id", ""), col("condition", ""), col("action", ""), col("drawer"), col("drawer_confidence", "inferred"), col("drawer_basis", ""), col("source_file"))
    meta = F.struct(col("theorist_model"), col("auditor_model"), F.lit("SURVIVED").alias("auditor_verdict"), F.lit(extracted_at).alias("extraction_date"), col("bundle_id", ""), col("source_tier"), col("provider"))
    review = F.struct(F.lit("UNVALIDATED").alias("status"), null.alias("promoted_by"), null.alias("promoted_date"), null.alias("validation"))
    return signatures.select(F.lit("CLAIM").alias("claim_type"), F.lit(system).alias("source_system"), col("source_title", ""), col("source_url", ""), col("source_timestamp", ""), col("source_quote", ""), signature.alias("signature"), meta.alias("extraction_meta"), review.alias("review"))
