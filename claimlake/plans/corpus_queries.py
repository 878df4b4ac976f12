from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corpus, coverage, joins, reports, similarity
from .registry import query, table

RULES = (("ENGLISH", ("the ", "of ")), ("FRENCH", ("que ",)), ("GERMAN", ("und ", "der ")))
TOPICS = (("A", r"tion|sion"), ("B", r"menta|mente"), ("C", r"keit|heit"), ("D", r"[0-9]{4}"))


def catalogue(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(F.col("doc_id").alias("ord"), F.col("doc_id").alias("id"), corpus.categorize(F.col("text"), RULES).alias("category"), F.col("n_chars").alias("view_count"), F.col("source").alias("upload_date"), F.substring("text", 1, 60).alias("title"), corpus.tag_topics(F.col("text"), TOPICS).alias("topics"))


_CATALOGUE = """with c as (select doc_id as ord, doc_id as id, n_chars as view_count, source as upload_date, substr(text, 1, 60) as title, text,
  case when contains(lower(text), 'the ') or contains(lower(text), 'of ') then 'ENGLISH' when contains(lower(text), 'que ') then 'FRENCH'
  when contains(lower(text), 'und ') or contains(lower(text), 'der ') then 'GERMAN' else 'UNKNOWN' end as category,
  list_filter(['A', 'B', 'C', 'D'], lambda x: case x when 'A' then regexp_matches(lower(text), 'tion|sion') when 'B' then regexp_matches(lower(text), 'menta|mente') when 'C' then regexp_matches(lower(text), 'keit|heit') else regexp_matches(lower(text), '[0-9]{4}') end) as topics from documents)"""


@query(_CATALOGUE + " select id, category, array_to_string(topics, ',') as topics from c")
def topic_tags(spark, folder):
    return catalogue(spark, folder).select("id", "category", F.array_join("topics", ",").alias("topics"))


@query(_CATALOGUE + " select 'category' as kind, category as name, count(*) as n from c group by 2 union all select 'topic', unnest(topics), count(*) from c group by 2")
def corpus_map(spark, folder):
    rows = catalogue(spark, folder)
    topics = rows.select(F.lit("topic").alias("kind"), F.explode("topics").alias("name"))
    return rows.select(F.lit("category").alias("kind"), F.col("category").alias("name")).unionByName(topics).groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))


ORDER = ("GERMAN", "FRENCH", "ENGLISH")


@query(_CATALOGUE + " select id, row_number() over (order by case category when 'GERMAN' then 0 when 'FRENCH' then 1 when 'ENGLISH' then 2 else 99 end, view_count desc, ord) as position from c")
def queue_positions(spark, folder):
    return corpus.build_queue(catalogue(spark, folder), "mentorship_first", ORDER).select("id", "position")


@query("select doc_id as id, row_number() over (order by source, doc_id) as position from documents")
def queue_chronological(spark, folder):
    return corpus.build_queue(catalogue(spark, folder), "chronological").select("id", "position")


@query("select doc_id as id, row_number() over (order by n_chars desc, doc_id) as position from documents")
def queue_by_views(spark, folder):
    return corpus.build_queue(catalogue(spark, folder), "views").select("id", "position")


@query(_CATALOGUE + " select category, rank, id, title from (select *, (row_number() over (partition by category order by view_count desc, ord))::int as rank from c) where rank <= 5")
def top5_per_category(spark, folder):
    return corpus.top_per(catalogue(spark, folder), "category", [F.desc("view_count"), F.col("ord")], 5).select("category", "rank", "id", "title")


@query("select doc_id, case when n_chars < 600 then 'SHORT' when n_chars < 3600 then 'MEDIUM' else 'LONG' end as bucket, case when n_chars < 100 then 'visual' else 'text' end as route from documents")
def buckets_and_routes(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.bucketize(F.col("n_chars"), [(600, "SHORT"), (3600, "MEDIUM")], "LONG").alias("bucket"), T.bucketize(F.col("n_chars"), [(100, "visual")], "text").alias("route"))


@query("""with m as (select d.source, l.quality, contains(lower(d.text), 'tion')::int + contains(lower(d.text), 'ment')::int as terms, contains(lower(d.text), 'ung')::int as errors from documents d join labels l using (doc_id)),
g as (select source, count(*) as total, count(*) filter (where quality = 0) as rejected, round_even(sum(errors) / greatest(sum(terms), 1), 4) as error_rate from m group by source),
r as (select *, rejected / greatest(total, 1) as x from g),
t as (select source, total, rejected, error_rate, round(x, 4) as rate, case when total >= 10 then 'PASS' else 'FAIL (' || total || ')' end as signatures, x between 0.1 and 0.3 as rejection_ok, error_rate <= 0.05 as jargon_ok from r)
select *, signatures = 'PASS' and rejection_ok and jargon_ok as all_pass from t""")
def gates_by_source(spark, folder):
    met = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    low = F.lower("text")
    found = lambda *words: sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))
    out = met.groupBy("source").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("quality") == 0).alias("rejected"), F.bround(F.sum(found("ung")) / F.greatest(F.sum(found("tion", "ment")), F.lit(1)), 4).alias("error_rate"))
    told = corpus.gates(out)
    return told.select("source", "total", "rejected", "error_rate", "rate", "signatures", (F.col("rejection") == "PASS").alias("rejection_ok"), (F.col("jargon") == "PASS").alias("jargon_ok"), "all_pass")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def zero_yield(spark, folder):
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left_anti").select("doc_id")


@query("select doc_id, case when length(text) < 100 then 'insufficient_content' end as error from documents")
def min_content(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.when(F.length("text") < 100, "insufficient_content").alias("error"))


@query("""select doc_id, case when doc_id % 3 = 0 then 'QUEUED' else 'DONE' end as status, case when doc_id % 3 <> 0 then 'skip' when row_number() over (order by doc_id % 3, doc_id) <= 50 then 'run' else 'wait' end as action from documents""")
def plan_queue(spark, folder):
    from ..operators.ordinal import with_ordinal

    rows = table(spark, folder, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "QUEUED").otherwise("DONE").alias("status"))
    pending = with_ordinal(rows.where("status = 'QUEUED'"), [F.col("doc_id")], "n")
    met = rows.join(pending.select("doc_id", "n"), "doc_id", "left")
    return met.select("doc_id", "status", F.when(F.col("n").isNull(), "skip").when(F.col("n") <= 50, "run").otherwise("wait").alias("action"))


def log(spark, folder):
    return table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("session"), F.round(F.abs("value") / 1000, 6).alias("cost"), "event_type")


_LOG = "with log as (select event_id, ts, user_id as session, round(abs(value) / 1000, 6) as cost, event_type, ts::date as day from events)"


@query(_LOG + """, r as (select event_id, round(sum(cost) over (partition by session order by ts, event_id rows unbounded preceding), 6) as session_total, round(sum(cost) over (partition by day order by ts, event_id rows unbounded preceding), 6) as daily_total, session, ts from log)
select event_id, session_total, daily_total, greatest(0.0, round(0.5 - session_total, 6)) as remaining, max(session_total >= 0.5 or daily_total >= 1.0) over (partition by session order by ts, event_id rows unbounded preceding) as halted from r""")
def cost_guard(spark, folder):
    return corpus.cost_guard(log(spark, folder).drop("event_type"), 0.5, 1.0).select("event_id", "session_total", "daily_total", "remaining", "halted")


@query("""select event_id, n::int as turn, case when n >= 20 then 'HALT' when n >= 15 then 'WARN' else 'OK' end as state, round(n * 100.0 / 20, 1)::double as pct_used from (select event_id, row_number() over (partition by user_id order by ts, event_id) as n from events)""")
def turn_guard(spark, folder):
    return corpus.turn_guard(log(spark, folder).select("event_id", "ts", "session")).select("event_id", "turn", "state", F.col("pct_used").cast("double").alias("pct_used"))


@query("""select event_id, round(g / 1e6, 3) as gap_s, coalesce(round(g / 1e6, 3) >= 300, false) as stalled from (select event_id, epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id) as g from events)""")
def stall_gaps(spark, folder):
    return corpus.stall_guard(log(spark, folder).select("event_id", "ts", "session")).select("event_id", "gap_s", "stalled")


@query(_LOG + """, g as (select session, row_number() over (partition by session order by ts, event_id) as turn, epoch_us(ts) - lag(epoch_us(ts)) over (partition by session order by ts, event_id) as gap,
  round(sum(cost) over (partition by session order by ts, event_id rows unbounded preceding), 6) >= 0.5 or round(sum(cost) over (partition by day order by ts, event_id rows unbounded preceding), 6) >= 1.0 as dear from log),
s as (select session, max(turn) < 20 as turns_ok, not coalesce(bool_or(round(gap / 1e6, 3) >= 86400), false) as active, not bool_or(dear) as within_cost from g group by session)
select *, turns_ok and active and within_cost as allowed, turns_ok and within_cost as allowed_unwatched from s""")
def guard_status(spark, folder):
    """All three guards, and what they say with the watchdog switched off."""
    rows = log(spark, folder)
    unwatched = corpus.guard_status(rows, 20, None, (0.5, 1.0)).select("session", F.col("allowed").alias("allowed_unwatched"))
    return corpus.guard_status(rows, 20, 1440, (0.5, 1.0)).join(unwatched, "session")


@query(_LOG + " select day, round(sum(cost), 4) as cost, count(*) as n, count(*) >= 25 as compress from log group by day")
def daily_cost(spark, folder):
    rows = log(spark, folder).groupBy(F.to_date("ts").alias("day")).agg(F.round(F.sum("cost"), 4).alias("cost"), F.count(F.lit(1)).alias("n"))
    return rows.withColumn("compress", F.col("n") >= 25)


@query("select event_id, user_id from events order by ts desc, event_id desc limit 20")
def last_n_events(spark, folder):
    return corpus.last_n(table(spark, folder, "events"), [F.desc("ts"), F.desc("event_id")], 20).select("event_id", "user_id")


@query("""with n as (select event_type, user_id, event_id, row_number() over (order by event_type, event_id) as pos from events), t as (select count(*) as n from events)
select pos, event_type, event_id::varchar as line from n where pos <= 150 union all select 151, null, '... ' || (n - 150) || ' more' from t where n > 150""")
def capped_listing(spark, folder):
    events = table(spark, folder, "events")
    from ..operators.ordinal import with_ordinal

    first = events.orderBy("event_type", "event_id").limit(150)
    shown = with_ordinal(first, [F.col("event_type"), F.col("event_id")], "pos").select("pos", "event_type", F.col("event_id").cast("string").alias("line"))
    more = events.agg(F.count(F.lit(1)).alias("n")).where("n > 150").select(F.lit(151).cast("long").alias("pos"), F.lit(None).cast("string").alias("event_type"), F.format_string("... %d more", F.col("n") - 150).alias("line"))
    return shown.unionByName(more)


ROUTES = [("default", "view", "small"), ("gold", "view", "large"), ("default", "click", "small"), ("gold", "purchase", "large")]
PRICES = [("small", 0.5, 1.5), ("large", 3.0, 15.0)]


@query("""with routes(tier, role, model) as (values ('default', 'view', 'small'), ('gold', 'view', 'large'), ('default', 'click', 'small'), ('gold', 'purchase', 'large')),
prices(model, i, o) as (values ('small', 0.5, 1.5), ('large', 3.0, 15.0)),
calls as (select event_id, case when user_id % 2 = 0 then 'gold' else 'silver' end as tier, event_type as role from events)
select c.event_id, coalesce(e.model, d.model) as model, round(1000 / 1e6 * p.i + c.event_id % 100 / 1e6 * p.o, 8)::double as cost_usd
from calls c left join routes e on e.tier = c.tier and e.role = c.role left join routes d on d.tier = 'default' and d.role = c.role join prices p on p.model = coalesce(e.model, d.model)""")
def model_route_cost(spark, folder):
    calls = table(spark, folder, "events").select("event_id", F.when(F.col("user_id") % 2 == 0, "gold").otherwise("silver").alias("tier"), F.col("event_type").alias("role"), F.lit(1000).alias("prompt_tokens"), (F.col("event_id") % 100).alias("completion_tokens"))
    routed = joins.route_models(calls, spark.createDataFrame(ROUTES, "tier string, role string, model string"))
    priced = joins.call_cost(routed, spark.createDataFrame(PRICES, "model string, input_per_m double, output_per_m double"))
    return priced.select("event_id", "model", F.round("cost_usd", 8).alias("cost_usd"))


@query("""with q as (select doc_id as id, 'QUEUED' as status, null::varchar as bundle_id from documents), u as (select doc_id as id, min(case when quality = 1 then 'DONE' else 'FAILED' end) as status, min('B-' || doc_id) as bundle_id from labels group by doc_id)
select q.id, coalesce(u.status, q.status) as status, coalesce(u.bundle_id, q.bundle_id) as bundle_id from q left join u using (id)""")
def status_update(spark, folder):
    null = F.lit(None).cast("string")
    queue = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.lit("QUEUED").alias("status"), null.alias("bundle_id"), null.alias("error"))
    updates = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "DONE").otherwise("FAILED").alias("status"), F.concat(F.lit("B-"), F.col("doc_id").cast("string")).alias("bundle_id"), null.alias("error"))
    return joins.update_status(queue, updates).drop("error")


@query("""with c as (select source as bundle, lang as signature, min(doc_id) as claim from documents group by all), s as (select distinct doc_id as spec_id, case when doc_id % 2 = 0 then source end as bundle, lang as signature from documents)
select spec_id, signature, found_bundle, claim from (select s.spec_id, s.signature, c.bundle as found_bundle, c.claim, row_number() over (partition by s.spec_id order by c.bundle desc nulls last) as n from s left join c on c.signature = s.signature and (s.bundle is null or s.bundle = c.bundle)) where n = 1""")
def claims_latest(spark, folder):
    docs = table(spark, folder, "documents")
    claims = docs.groupBy(F.col("source").alias("bundle"), F.col("lang").alias("signature")).agg(F.min("doc_id").alias("claim"))
    specs = docs.select(F.col("doc_id").alias("spec_id"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("bundle"), F.col("lang").alias("signature"))
    return joins.find_claims(specs, claims)


def observations(spark, folder):
    """Documents as observations: the language is the concept, the source the source."""
    status = F.element_at(F.array(*map(F.lit, coverage.STATUSES)), (F.col("n_chars") % 4 + 1).cast("int"))
    return table(spark, folder, "documents").select(F.col("doc_id").alias("ord"), F.col("doc_id").alias("document"), F.concat_ws("-", "lang", (F.col("doc_id") % 20).cast("string")).alias("concept_id"), "source", status.alias("status"), F.col("lang").alias("drawer"))


_OBS = "with o as (select doc_id as ord, doc_id as document, lang || '-' || (doc_id % 20) as concept_id, source, ['PENDING', 'ABSENT', 'PARTIAL', 'FOUND'][n_chars % 4 + 1] as status, lang as drawer, n_chars % 4 as r from documents)"


@query(_OBS + " select concept_id, source, max_by(status, r) as status, coalesce(array_to_string(list_sort(list(distinct document) filter (where r >= 2)), ','), '') as documents from o group by all")
def coverage_ranked(spark, folder):
    return coverage.upgrade_ranked(observations(spark, folder)).withColumn("documents", F.array_join(F.transform("documents", lambda x: x.cast("string")), ","))


@query(_OBS + " select concept_id, source, case when bool_or(status = 'FOUND') then 'FOUND' else coalesce(min_by(status, ord) filter (where status in ('PARTIAL', 'ABSENT')), 'PENDING') end as status from o group by all")
def coverage_sticky(spark, folder):
    return coverage.upgrade_sticky(observations(spark, folder))


def cells(spark, folder):
    """The cells of the observations with the drawers of their concepts."""
    return coverage.upgrade_ranked(observations(spark, folder)).withColumn("drawer", F.split("concept_id", "-")[0]).drop("documents")


_CELLS = _OBS + ", s as (select concept_id, source, max_by(status, r) as status, split_part(concept_id, '-', 1) as drawer from o group by concept_id, source)"
_SUMMARY = _CELLS + """, g as (select case when grouping(status) = 0 then 'status' when grouping(drawer) = 0 then 'drawer' when grouping(source) = 0 then 'source' else 'total' end as dimension, coalesce(status, drawer, source, 'all') as value, count(*) as total, count(*) filter (where st = 'FOUND') as found from (select *, status as st from s) group by grouping sets ((status), (drawer), (source), ())
  union all select 'status', unnest(['PENDING', 'ABSENT', 'PARTIAL', 'FOUND', 'NOT_APPLICABLE']), 0, 0), m as (select dimension, value, sum(total)::bigint as total, sum(found)::bigint as found from g group by all)"""


@query(_SUMMARY + " select * from m")
def coverage_summary(spark, folder):
    return coverage.coverage_summary(cells(spark, folder))


@query(_SUMMARY + """, one as (select (select total from m where dimension = 'total') as a, (select total from m where dimension = 'status' and value = 'PENDING') as p, (select sum(total)::bigint from m where dimension = 'status' and value in ('FOUND', 'PARTIAL')) as e),
c as (select concept_id, bool_or(status = 'FOUND') as f, bool_or(status = 'PARTIAL') as h from s group by concept_id), k as (select count(*) as c, count(*) filter (where h and not f) as po, count(*) filter (where not h and not f) as ga from c),
r as (select 'status' as section, value as name, total as n, a as of from m, one where dimension = 'status' union all select dimension, value, found, total from m where dimension in ('source', 'drawer')
  union all select 'coverage', 'effective', e, a from one union all select 'evidence', 'partial_only', po, c from k union all select 'evidence', 'none', ga, c from k
  union all select 'recommendation', 'low_coverage:' || value, found, total from m where dimension = 'source' and round(100 * found / total, 1) < 20
  union all select 'recommendation', 'high_pending_rate', p, a from one where p > a * 0.5 union all select 'recommendation', 'coverage_gaps', ga, c from k where ga > 10)
select *, round(case when of > 0 then 100 * n / of else 0.0 end, 1)::double as percent from r""")
def coverage_report(spark, folder):
    return coverage.coverage_report(cells(spark, folder))


@query(_OBS + " select concept_id, 0::bigint as found from o group by concept_id having bool_and(status in ('ABSENT', 'PENDING'))")
def coverage_gaps(spark, folder):
    return coverage.coverage_gaps(observations(spark, folder))


@query(_CELLS + " select concept_id, string_agg(source || '=' || status, ' ' order by source || '=' || status) as cells from s group by concept_id")
def coverage_pivot(spark, folder):
    """All sources of each concept, as one column, since sources grow with the corpus."""
    return coverage.coverage_lines(cells(spark, folder))


def concepts(spark, folder):
    return table(spark, folder, "part").select(F.col("p_partkey").alias("concept_id"), F.col("p_partkey").alias("ord"), F.split(F.lower("p_name"), " ").alias("terms"), F.col("p_brand").alias("drawer_name"))


def claims_of_concepts(spark, folder):
    """Documents as claims: some name a concept, some have a drawer that is the head of several concepts' drawers."""
    doc, none = F.col("doc_id"), F.lit(None)
    drawer = F.when(doc % 7 == 0, F.concat(F.lit("brand#"), (doc % 5 + 1).cast("string")))
    return table(spark, folder, "documents").select(doc.alias("claim_id"), "text", drawer.alias("drawer"), F.when(doc % 50 == 0, doc).otherwise(none).cast("long").alias("concept_id"), "source")


_MATCHED = """with c as (select p_partkey as concept_id, upper(p_brand) as drawer, p_name from part), t as (select concept_id, unnest(string_split(lower(p_name), ' ')) as term from c),
d as (select doc_id as claim_id, text, source, case when doc_id % 7 = 0 then 'BRAND#' || (doc_id % 5 + 1) end as drawer, case when doc_id % 50 = 0 then doc_id end as direct from documents),
named as (select claim_id, c.concept_id, null::bigint as score, 1 as rank from d join c on c.concept_id = d.direct),
h as (select claim_id, term from d join (select distinct term from t) on contains(lower(text), term)),
p as (select claim_id, concept_id, 1 as points from h join t using (term) union all select claim_id, concept_id, 2 from d join c on contains(c.drawer, d.drawer) or contains(d.drawer, c.drawer)),
m as (select claim_id, concept_id, sum(points)::bigint as score from p where claim_id not in (select claim_id from named) group by all),
r as (select claim_id, concept_id, score, (row_number() over (partition by claim_id order by score desc, concept_id))::int as rank from m where score >= 2),
matched as (select * from r where rank <= 3 union all select * from named)"""


@query(_MATCHED + " select * from matched")
def concept_match(spark, folder):
    return joins.match_concepts(claims_of_concepts(spark, folder), concepts(spark, folder))


@query(_MATCHED + """, cell as (select p_partkey as concept_id, 'src' || (p_partkey % 20) as source, case when p_partkey % 3 = 0 then 'ABSENT' else 'PENDING' end as status, case when p_partkey % 3 = 0 then ['S-old'] else [] end as old from part),
x as (select concept_id, d.source, claim_id from matched join d using (claim_id)), f as (select concept_id, source, list('S-' || claim_id order by claim_id) as sig, list(distinct 'B-' || claim_id % 4) as bun, list(claim_id::varchar order by claim_id) as doc from x group by all)
select concept_id, source, case when f.sig is null then status else 'FOUND' end as status, array_to_string(list_concat(old, coalesce(f.sig, [])), ',') as signature_ids, coalesce(len(f.bun), 0)::int as n_bundles, array_to_string(coalesce(f.doc, []), ',') as documents from cell left join f using (concept_id, source)""")
def coverage_from_claims(spark, folder):
    """Cells of concepts in one source each, upgraded by the documents that match them."""
    claims = claims_of_concepts(spark, folder)
    key, null = F.col("p_partkey"), F.lit(None)
    cell = table(spark, folder, "part").select(
        key.alias("concept_id"), F.concat(F.lit("src"), (key % 20).cast("string")).alias("source"), F.when(key % 3 == 0, "ABSENT").otherwise("PENDING").alias("status"),
        F.when(key % 3 == 0, F.array(F.lit("S-old"))).alias("signature_ids"), null.cast("array<string>").alias("bundles"), null.cast("array<string>").alias("documents"),
    )
    claim = F.col("claim_id")
    matches = joins.match_concepts(claims, concepts(spark, folder)).join(claims.select("claim_id", "source"), "claim_id")
    matches = matches.select("concept_id", "source", claim.alias("ord"), F.concat(F.lit("S-"), claim.cast("string")).alias("signature_id"), F.concat(F.lit("B-"), (claim % 4).cast("string")).alias("bundle"), claim.alias("document"))
    out = coverage.from_claims(cell, matches)
    return out.select("concept_id", "source", "status", F.array_join("signature_ids", ",").alias("signature_ids"), F.size("bundles").alias("n_bundles"), F.array_join("documents", ",").alias("documents"))


@query("select count(*) filter (where quality is null) as total_pending, count(*) filter (where quality = 1) as processed, count(*) filter (where quality = 0 and toxic = 0) as failed, count(*) filter (where quality = 0 and toxic = 1) as skipped from documents left join labels using (doc_id)")
def run_summary(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    status = F.when(F.col("quality") == 1, "DONE").when(F.col("toxic") == 0, "FAILED").otherwise("SKIPPED")
    return reports.run_summary(labels.join(docs.select("doc_id"), "doc_id").select(F.col("doc_id").alias("id"), status.alias("status")), docs.join(labels, "doc_id", "left_anti").select(F.col("doc_id").alias("id")))


_TF = r"""with r as (select min(doc_id) as doc_id, text from documents where regexp_matches(text, '[\p{L}\p{N}_]') group by text), t as (select doc_id as id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) as token from r), f as (select id, token, count(*) as tf from t group by all), n as (select id, sum(tf * tf)::double as sq from f group by id)"""


@query(
    _TF
    + """ select a.id as a, b.id as b, round(sum(a.tf * b.tf)::double / (sqrt(any_value(x.sq)) * sqrt(any_value(y.sq))), 6) as similarity from f a join f b on a.token = b.token and a.id < b.id join n x on x.id = a.id join n y on y.id = b.id group by 1, 2 having sum(a.tf * b.tf)::double / (sqrt(any_value(x.sq)) * sqrt(any_value(y.sq))) >= 0.95
union all select r.doc_id, d.doc_id, 1.0 from documents d join r on r.text = d.text and r.doc_id < d.doc_id"""
)
def redundant_pairs(spark, folder):
    """Pairs of different texts, each by its first document, and links from that to its copies."""
    return similarity.redundant(table(spark, folder, "documents"), 0.95, "doc_id", "text").withColumn("similarity", F.round("similarity", 6))


@query(
    r"""with recursive r as (select min(doc_id) as doc_id, lang, text from documents where regexp_matches(text, '[\p{L}\p{N}_]') and lang is not null group by lang, text),
t as (select doc_id as id, lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) as token from r), f as (select id, lang, token, count(*) as tf from t group by all), n as (select id, sum(tf * tf)::double as sq from f group by id),
pairs as (select a.id as a, b.id as b, sum(a.tf * b.tf)::double / (sqrt(any_value(x.sq)) * sqrt(any_value(y.sq))) as similarity from f a join f b on a.token = b.token and a.lang = b.lang and a.id < b.id join n x on x.id = a.id join n y on y.id = b.id group by 1, 2
  union all select r.doc_id, d.doc_id, 1.0 from documents d join r on r.text = d.text and r.lang = d.lang and r.doc_id < d.doc_id),
near as (select b as id, a as other from pairs where similarity >= 0.95 qualify rank() over (partition by b order by similarity desc) = 1),
reached as (select id, other from near union select reached.id, near.other from reached join near on near.id = reached.other),
roots as (select id, min(other) as root from reached where other not in (select id from near) group by id)
select doc_id, coalesce(root, doc_id) as root from documents left join roots on id = doc_id"""
)
def greedy_clusters(spark, folder):
    docs = table(spark, folder, "documents")
    pairs = similarity.redundant(docs, 0.95, "doc_id", "text", by="lang", best=True)
    return similarity.greedy_cluster(docs, pairs, "doc_id").withColumnRenamed("id", "doc_id")
