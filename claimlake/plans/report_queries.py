"""Listings, reports, logs and archives of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prompts, reports
from ..sources import records, sinks
from ..sources.shared import scratch_path
from .corpus_queries import _CATALOGUE, catalogue
from .record_queries import _events
from .registry import query, table


@query("""select event_id::varchar as id, case when datediff('day', ts::date, (select max(ts)::date from events)) >= 7 then 'archived' else 'live' end as part, ts::date::varchar as session_date from events""")
def archive_rewritten(spark, folder):
    """Events written by day, old days moved to an archive, both read back."""
    live, archived = scratch_path(spark, "live"), scratch_path(spark, "archived")
    events = _events(spark, folder)
    sinks.append_events(events, live)
    today = events.agg(F.max(F.substring("timestamp", 1, 10))).first()[0]
    sinks.archive_events(spark, live, archived, today, 7)
    return sinks.read_archived(spark, live, archived).select("id", "part", F.col("session_date").cast("string").alias("session_date"))


@query("""select 'N-' || lpad(n::varchar, greatest(3, length(n::varchar))::int, '0') as id, 'lang ' || lang as reason, doc_id::varchar as source_signature, source as source_bundle, rejected_by from
  (select doc_id, lang, source, case when doc_id % 2 = 0 then 'human' else 'auditor' end as rejected_by, row_number() over (order by doc_id) as n from documents where lang is not null)""")
def negatives_logged(spark, folder):
    """Rejections numbered, appended to the log by day, and read back by type."""
    path = scratch_path(spark, "negatives")
    doc = F.col("doc_id")
    rejections = table(spark, folder, "documents").where("lang is not null").select(doc.alias("rej_id"), F.concat(F.lit("lang "), "lang").alias("reason"), doc.alias("signature"), F.col("source").alias("bundle"), F.when(doc % 2 == 0, "human").alias("rejected_by"))
    sinks.append_events(reports.negative_events(rejections, "2024-01-01T00:00:00"), path)
    found = records.read_events(spark, path, "NEGATIVE")
    of = lambda k: F.col("metadata")[k].alias(k)
    return found.select("id", "reason", of("source_signature"), of("source_bundle"), of("rejected_by"))


_VIDEOS = _CATALOGUE + ", v as (select *, case when ord % 9 > 0 then 'u' || ord end as url, view_count * 7 as duration from c)"


def videos(spark, folder):
    return catalogue(spark, folder).withColumns({"url": F.when(F.col("ord") % 9 > 0, F.concat(F.lit("u"), F.col("ord").cast("string"))), "duration": F.col("view_count") * 7})


@query(_VIDEOS + """ select category, rank, '- [' || coalesce(nullif(title, ''), '?') || '](' || coalesce(url, '') || ') — ' || format('{:,}', view_count) || ' views, ' || duration // 60 || 'min' || case when len(topics) > 0 then ' [' || array_to_string(topics, ', ') || ']' else '' end as line
  from (select *, (row_number() over (partition by category order by view_count desc, ord))::int as rank from v) where rank <= 5""")
def cluster_report(spark, folder):
    return reports.cluster_report(videos(spark, folder))


@query(_VIDEOS + ", t as (select topic, count(*) as n from (select unnest(topics) as topic from v) group by topic) select *, row_number() over (order by n desc, topic) as place from t")
def topic_report(spark, folder):
    return reports.topic_report(videos(spark, folder))


def _claims(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(F.col("doc_id").alias("ord"), F.when(F.col("doc_id") % 7 > 0, F.col("doc_id") % 7).cast("int").alias("drawer"), F.col("lang").alias("condition"), F.col("source").alias("action"), F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("f"), F.col("doc_id").cast("string"))).alias("source_file"))


@query("""with n as (select doc_id, lang, source, (doc_id % 7)::int as drawer, row_number() over (order by doc_id % 7, doc_id) as pos from documents)
select pos, drawer, '- IF ' || coalesce(lang, '') || ' → THEN ' || coalesce(source, '') || ' (' || case when doc_id % 4 > 0 then 'f' || doc_id else 'unknown' end || ')' as line from n where pos <= 150
union all select 151, null, '... and ' || (count(*) - 150) || ' more claims truncated' from documents having count(*) > 150""")
def claims_listing(spark, folder):
    return reports.capped_listing(_claims(spark, folder), 150)


@query("""with q as (select doc_id as id, doc_id % 3 = 0 as pending, doc_id % 6 > 0 as linked, row_number() over (partition by doc_id % 3 = 0 order by n_chars, doc_id) as place from documents)
select id, case when not pending then 'done' when place > 100 then 'wait' when not linked then 'skip' else 'dry_run' end as action from q""")
def queue_plan(spark, folder):
    doc = F.col("doc_id")
    queue = table(spark, folder, "documents").select(doc.alias("id"), F.when(doc % 3 == 0, "QUEUED").otherwise("DONE").alias("status"), F.when(doc % 6 > 0, doc.cast("string")).alias("url"), F.col("n_chars").alias("position"))
    return reports.plan_queue(queue, 100, dry_run=True).select("id", "action")


def _turns(spark, folder):
    return table(spark, folder, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("seg_no"), (F.col("turn") * 47.5).alias("start"), "text")


@query("""select conv_id as doc_id, max(case when turn = a then m end) || '-' || max(case when turn = b then m end) as span from (select conv_id, turn, (floor(turn * 47.5)::bigint // 60) || ':' || lpad((floor(turn * 47.5)::bigint % 60)::varchar, 2, '0') as m,
  min(turn) over (partition by conv_id) as a, max(turn) over (partition by conv_id) as b from conversations) group by conv_id""")
def timestamp_ranges(spark, folder):
    turns = _turns(spark, folder)
    return prompts.timestamp_range(turns, turns.select("doc_id").distinct())


@query("""select conv_id as doc_id, string_agg('[' || lpad((s // 60)::varchar, 2, '0') || ':' || lpad((s % 60)::varchar, 2, '0') || '] ' || trim(text, ' '), chr(10) order by turn) as content
  from (select *, floor(turn * 47.5)::bigint as s from conversations) where trim(text, ' ') <> '' group by conv_id""")
def timed_lines(spark, folder):
    return prompts.timed_lines(_turns(spark, folder))


def _clusters(spark, folder):
    doc = F.col("doc_id")
    return table(spark, folder, "documents").select(F.coalesce((doc % 5 + 1), F.lit(1)).cast("int").alias("drawer"), (doc % 40).alias("root"), F.concat(F.lit("T"), (doc % 40).cast("string")).alias("topic"), F.format_string("S-%05d", doc).alias("id"))


@query("""with c as (select (doc_id % 5 + 1)::int as drawer, doc_id % 40 as root, 'S-' || lpad(doc_id::varchar, 5, '0') as id, row_number() over (partition by doc_id % 40 order by lpad(doc_id::varchar, 5, '0')) as r from documents)
select drawer, root, '- **Drawer ' || drawer || '** | CLUSTER: T' || root || ' | Entries: ' || string_agg(id, ', ' order by id) filter (where r <= 5) || case when count(*) > 5 then '...' else '' end as line from c group by drawer, root""")
def theory_index(spark, folder):
    return reports.theory_index(_clusters(spark, folder))


@query("select (select count(*) from documents) as entries, (select count(distinct doc_id % 40) from documents) as clusters, (select count(*) from labels where quality = 0) as negatives")
def theory_totals(spark, folder):
    return reports.theory_totals(_clusters(spark, folder), table(spark, folder, "labels").where("quality = 0"))


def _echo(prompts_: list[str]) -> list[str | None]:
    """A responder that gives a prompt's first ten characters, their spaces marked, and none to an empty prompt."""
    return [p[:10].replace(" ", "_") or None for p in prompts_]


@query("select doc_id, nullif(replace(left(text, 10), ' ', '_'), '') as response from documents")
def model_responses(spark, folder):
    """Answers of a responder to all documents, each distinct one asked once, joined from the table they were written to."""
    rows = table(spark, folder, "documents").select("doc_id", F.col("text").alias("prompt"))
    return prompts.with_model_responses(rows, _echo, scratch_path(spark, "answers")).select("doc_id", "response")
