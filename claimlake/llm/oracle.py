"""SQL that gives the rows of the queries in catalog, for those that SQL can express."""

from __future__ import annotations

from .licences import RULES, SENTENCES
from .perspective import CONTEXT_ROLES
from .warc import BASE32_DIGITS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licence_sql() -> str:
    norm = lambda x: f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    lexicon = ", ".join(f"({_quoted(name)}, {_quoted(sentence)})" for name, sentence in SENTENCES)
    rest, steps = "rest", []
    for name, sequence in RULES:
        needle = _quoted("".join(f"|{x}|" for x in sequence))
        steps.append(f"case when contains({rest}, {needle}) then {_quoted(name)} end")
        rest = f"replace({rest}, {needle}, '#')"
    return f"""
with lexicon as (select min(name) as sentence_id, {norm("sentence")} as norm from (values {lexicon}) t(name, sentence) group by 2),
lines as (select doc_id, regexp_split_to_array(regexp_replace(text, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), '[\\r\\n]+') as l from documents where text is not null),
placed as (select doc_id, unnest(l) as line, generate_subscripts(l, 1) as pos from lines),
known as (select doc_id, pos, sentence_id from placed join lexicon on lexicon.norm = {norm("line")}),
joined as (select doc_id, string_agg(sentence_id, ' ' order by pos) as sentence_ids, '|' || string_agg(sentence_id, '||' order by pos) || '|' as rest from known group by doc_id),
matched as (select doc_id, sentence_ids, concat_ws(' ', {", ".join(steps)}) as licences from joined)
select * from matched where licences <> ''"""


_CONTEXT = ", ".join(map(_quoted, CONTEXT_ROLES))
_BASE32 = " || ".join(f"lpad(to_base(('0x' || substr(s, {at}, 10))::bigint, 32), 8, '0')" for at in (1, 11, 21, 31))

ORACLE_SQL = {
    "op4_perspective_rotation": f"""
with r as (select conv_id, turn, coalesce(role, 'unknown') as speaker, regexp_replace(coalesce(text, ''), '<(\\\\*)\\|', '<\\1\\\\|', 'g') as text from conversations),
p as (select distinct conv_id, speaker as perspective from r where speaker not in ({_CONTEXT})),
s as (select conv_id, perspective, turn, speaker, text, speaker = perspective as own,
  case when speaker = perspective then '<|assistant|>' || chr(10) when speaker in ({_CONTEXT}) then '<|' || speaker || '|>' || chr(10) else '<|user name=' || speaker || '|>' || chr(10) end as head
  from r join p using (conv_id)),
o as (select *, sum(length(head) + length(text) + 8) over (partition by conv_id, perspective order by turn, speaker, text rows unbounded preceding) - 8 as stop from s)
select conv_id, perspective, string_agg(head || text || '<|end|>' || chr(10), '' order by turn, speaker, text) as rendered,
  coalesce(string_agg((stop - length(text))::bigint || ':' || stop::bigint, ',' order by stop) filter (where own), '') as mask,
  count(*) as n_turns, count(*) filter (where own) as n_own
from o group by conv_id, perspective""",
    "op5_exact_dedup": r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256 from n""",
    "op6_licence_rules": _licence_sql(),
    "op7_ngram_jaccard_join": r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as sh from w),
n as (select doc_id, count(*) as k from s group by doc_id),
pairs as (select a.doc_id as u, b.doc_id as v, count(*) as common from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2),
links as (select u, v from pairs join n a on a.doc_id = u join n b on b.doc_id = v where 100 * common >= 80 * (a.k + b.k - common)),
reach(u, v) as (select u, v from links union select reach.u, links.v from reach join links on links.u = reach.v)
select d.doc_id, coalesce(any_value(n.k), 0) as n_shingles, least(d.doc_id, coalesce(min(reach.v), d.doc_id)) as component_id
from documents d left join n using (doc_id) left join reach on reach.u = d.doc_id group by d.doc_id""",
    "op9_warc": f"""
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, h, sha1(h) as s, max(page_id) over (partition by h) as original from p)
select page_id, strlen(h) as payload_bytes, translate({_BASE32}, '{BASE32_DIGITS[0]}', '{BASE32_DIGITS[1]}') as payload_digest,
  case when original = page_id then 'response' else 'revisit' end as record_type, case when original <> page_id then original end as refers_to,
  case when original = page_id then true end as payload_ok from d""",
    "op10_exact_top_k": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id as vec_id, list_inner_product(q.v, c.v)::bigint as score from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0)
select * from (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from s) where rank <= 5""",
    "op12_importance_resampling": r"""
with tab as (select list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
f as (select doc_id, unnest(ws) as w from d),
g as (select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from benchmark),
v as (select w, hex(encode(w)) as x from (select w from f union select w from g)),
k as (select w, xor(list_reduce([4294967295] || list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket from v, tab),
source as (select bucket, count(*) as s from f join k using (w) group by bucket), target as (select bucket, count(*) as t from g join k using (w) group by bucket),
total as (select (select count(*) from f) as s_all, (select count(*) from g) as t_all),
gains as (select w, floor(1000 * ln((coalesce(t, 0) + 1)::double * (s_all + 10000) / ((coalesce(s, 0) + 1)::double * (t_all + 10000))))::bigint as gain from k left join source using (bucket) left join target using (bucket), total),
weighed as (select doc_id, count(*) as n, floor(sum(gain) / count(*))::bigint as weight from f join gains using (w) group by doc_id),
scored as (select d.doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score from d left join weighed using (doc_id)),
placed as (select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place, count(*) over (partition by n_features >= 20) as n from scored)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= 10 * n // 100 then place end as rank from placed""",
    "op13_url_filter": r"""
with recursive rules(verdict, h, p) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
a as (select page_id, html, url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end as rest from pages),
b as (select page_id, html, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path, regexp_extract(url, '^[^#]*') as node from a),
links as (select node as u, unnest(list_concat(regexp_extract_all(html, '(?i)<link\srel="canonical"\shref="([^"#]*)', 1), regexp_extract_all(html, '(?i)<meta\shttp-equiv="refresh"\scontent="[0-9]*;\s*url=([^"#]*)', 1))) as v from b),
nodes as (select node, host, path from b union select v, regexp_extract(v, '://([^/?#]*)', 1), regexp_extract(v, '://[^/?#]*([^?#]*)', 1) from links),
ruled as (select n.node, n.host, n.path, max_by(r.h || r.p, length(r.h || r.p)) as rule, max_by(r.verdict, length(r.h || r.p)) as verdict
  from nodes n left join rules r on n.host <> '' and ends_with('.' || n.host, '.' || r.h) and starts_with(n.path, r.p) group by all),
reach(node) as (select node from ruled where verdict = 'block' union select case when links.u = reach.node then links.v else links.u end from reach join links on reach.node in (links.u, links.v))
select b.page_id, b.host, b.path, ruled.rule, coalesce(ruled.verdict, case when b.node in (from reach) then 'block' else 'allow' end) as verdict, ruled.verdict is null and b.node in (from reach) as alias
from b join ruled on ruled.node is not distinct from b.node and ruled.host = b.host and ruled.path = b.path""",
}
