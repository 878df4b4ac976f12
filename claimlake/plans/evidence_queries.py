"""Reasons of verdicts, and the evidence that observations leave in the cells of a coverage matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..operators import corpus, coverage, rules
from .corpus_queries import observations
from .registry import query, table
from .text_queries import AUDIT_SQL, PAIRS, verdicts


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _told(at: int) -> str:
    """SQL of the reason (1) or citation (2) of a failed check."""
    pair = "case " + " ".join(f"when contains(lower(condition), '{a}') and contains(lower(action), '{b}') then [{_quoted(a)}, {_quoted(b)}]" for a, b in PAIRS) + " end"
    fill = {"falsifiability": ["split_part(check_failed, ':', 2)"], "tautology:pair": [f"({pair})[1]", f"({pair})[2]"], "tautology:overlap": ["len(list_intersect(cw, aw))"], "ambiguity:condition": ["split_part(check_failed, ':', 2)"], "ambiguity:action": ["split_part(check_failed, ':', 2)"]}
    cases = []
    for row in L.REASONS[:-1]:  # the last is of the rule against canon, which this audit lacks
        check, _, field = row[0].partition(":")
        texts = row[at].split("%s")
        value = " || ".join(x for pair in zip(map(_quoted, texts), [*fill.get(row[0], []), "''"], strict=False) for x in pair) if at == 1 else _quoted(row[at])
        cases.append(f"when check_failed like '{check}:%{field}' then {value}")
    return f"case {' '.join(cases)} end"


@query(AUDIT_SQL + f" select doc_id, id, {_told(1)} as reason, {_told(2)} as citation from verdicts where check_failed is not null")
def audit_reasons(spark, folder):
    _, rejected = rules.split_verdicts(verdicts(spark, folder))
    return rejected.select("doc_id", "id", "reason", "citation")


def matrix(spark, folder):
    """A cell for each concept and source of the observations; some have a status and evidence already."""
    n = (F.length("concept_id") + F.length("source")) % 4
    base = observations(spark, folder).select("concept_id", "source").distinct()
    held = n == 2
    none = F.array().cast("array<string>")
    return base.select(
        "concept_id", "source", F.element_at(F.array(*map(F.lit, coverage.STATUSES)), (n % 3 + 1).cast("int")).alias("status"),
        F.when(held, F.array(F.concat(F.lit("OLD-"), "concept_id"))).otherwise(none).alias("signature_ids"), F.when(held, F.array(F.lit("old"))).otherwise(none).alias("documents"),
    )


def sightings(spark, folder):
    """The observations, with times, and signatures for most."""
    doc = F.col("ord")
    return observations(spark, folder).select("concept_id", "source", "ord", "status", F.col("document").cast("string").alias("document"), F.when(doc % 3 > 0, doc.cast("string")).alias("timestamp"), F.when(doc % 5 > 0, "IF x").otherwise("").alias("signature"))


_SEEN = """with o as (select lang || '-' || (doc_id % 20) as concept_id, source, doc_id as ord, ['PENDING', 'ABSENT', 'PARTIAL', 'FOUND'][n_chars % 4 + 1] as status, doc_id::varchar as document,
  case when doc_id % 3 > 0 then doc_id::varchar end as timestamp, case when doc_id % 5 > 0 then 'IF x' else '' end as signature, case n_chars % 4 when 3 then 3 when 2 then 2 else 1 end as r from documents),
cells as (select concept_id, source, n, ['PENDING', 'ABSENT', 'PARTIAL', 'FOUND'][n % 3 + 1] as status, n % 3 as held, case when n = 2 then ['OLD-' || concept_id] else [] end as ids, case when n = 2 then ['old'] else [] end as docs
  from (select distinct concept_id, source, (length(concept_id) + length(source)) % 4 as n from o))"""


@query(_SEEN + """, runs as (select o.*, c.held, c.ids, c.docs, greatest(c.held, coalesce(max(o.r) over (partition by concept_id, source order by ord rows between unbounded preceding and 1 preceding), 0)) as before from o join cells c using (concept_id, source)),
ups as (select *, case when r >= 2 then count(*) filter (where r >= 2) over (partition by concept_id, source order by ord) end as k from runs where r > before),
last as (select concept_id, source, max_by(r, ord) as r, max_by(coalesce(timestamp, ''), ord) as at, list(document) filter (where r >= 2) as new, list('TAX-' || concept_id || '-' || (len(ids) + k) order by ord) filter (where r >= 2) as made from ups group by all)
select c.concept_id, c.source, case l.r when 3 then 'FOUND' when 2 then 'PARTIAL' when 1 then 'ABSENT' else c.status end as status, case when l.r = 1 then '' else array_to_string(list_concat(c.ids, coalesce(l.made, [])), ',') end as signature_ids,
  case when l.r = 1 then '' when l.r is null then array_to_string(c.docs, ',') else array_to_string(list_sort(list_distinct(list_concat(c.docs, l.new))), ',') end as documents, case when l.r > 1 then l.at else '' end as timestamps
from cells c left join last l on l.concept_id = c.concept_id and l.source = c.source""")
def coverage_evidence(spark, folder):
    out = coverage.upgrade_ranked_with_evidence(matrix(spark, folder), sightings(spark, folder), "TAX")
    return out.select("concept_id", "source", "status", *(F.array_join(c, ",").alias(c) for c in ("signature_ids", "documents", "timestamps")))


@query(_SEEN + """, a as (select concept_id, source, bool_or(status = 'FOUND') as f, min_by(status, ord) filter (where status in ('PARTIAL', 'ABSENT')) as s, count(*) filter (where status = 'FOUND' and signature <> '') as n, list(document order by ord) filter (where status = 'FOUND') as d from o group by all)
select c.concept_id, c.source, case when f then 'FOUND' when c.status = 'PENDING' then coalesce(s, 'PENDING') else c.status end as status, len(ids) + a.n as n_signatures, array_to_string(list_concat(docs, coalesce(d, [])), ',') as documents from cells c join a using (concept_id, source)""")
def coverage_sticky_evidence(spark, folder):
    return coverage.upgrade_sticky_with_evidence(matrix(spark, folder), sightings(spark, folder)).withColumn("documents", F.array_join("documents", ","))


@query(_SEEN + " select concept_id, source, ord, 'TAX-' || concept_id || '-' || (len(ids) + row_number() over (partition by concept_id, source order by ord)) as signature_id from o join cells using (concept_id, source) where o.status = 'FOUND' and signature <> ''")
def coverage_sticky_signatures(spark, folder):
    return coverage.sticky_signatures(matrix(spark, folder), sightings(spark, folder), "TAX")


@query("select coalesce(case p_size % 5 when 0 then 'UNIQUE' when 1 then 'STRONG_EVIDENCE' when 2 then 'MODERATE_EVIDENCE' when 3 then 'PRACTITIONER_LORE' end, 'UNKNOWN') as grade, count(*) as n, (select count(*) from part) as of from part group by 1")
def coverage_grades(spark, folder):
    names = F.array(*map(F.lit, ("UNIQUE", "STRONG_EVIDENCE", "MODERATE_EVIDENCE", "PRACTITIONER_LORE")))
    return coverage.grade_counts(table(spark, folder, "part").select(F.col("p_partkey").alias("concept_id"), F.get(names, F.col("p_size") % 5).alias("grade")))


@query(AUDIT_SQL + """, v as (select doc_id, id, (check_failed is not null)::int::double as bad, row_number() over (order by doc_id, id) as place from verdicts)
select doc_id, id, place, round(share, 6) as share, place >= 100 and share < 0.05 as drifting from (select *, avg(bad) over (order by place rows between 99 preceding and current row) as share from v)""")
def drift_alert(spark, folder):
    rows = verdicts(spark, folder).select("doc_id", "id", "verdict")
    return corpus.drift_alert(rows, ["doc_id", "id"]).select("doc_id", "id", "place", F.round("share", 6).alias("share"), "drifting")
