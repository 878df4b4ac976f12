from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunking
from .registry import query, table
from .text_queries import segments


def markdown(spark, folder):
    """Documents with a line for each sentence, of which those that begin with a vowel are headings."""
    lines = F.regexp_replace(F.regexp_replace("text", r"\. ", ".\n"), r"(?m)^([AEIOU][^\n]*)$", "## $1")
    return table(spark, folder, "documents").select("doc_id", lines.alias("text"))


_MD = r"""with md as (select doc_id, regexp_replace(regexp_replace(text, '\. ', '.' || chr(10), 'g'), '(?m)^([AEIOU][^\n]*)$', '## \1', 'g') as text from documents),
l as (select doc_id, generate_subscripts(string_split(text, chr(10)), 1) as n, unnest(string_split(text, chr(10))) as line from md),
h as (select *, regexp_matches(line, '^(#{1,6})[ \t]+(.+)$') as hd from l),
s as (select *, sum(hd::int) over (partition by doc_id order by n)::int as sec_no, bool_or(hd) over (partition by doc_id) as any_hd from h),
sec as (select doc_id, sec_no, coalesce(length(regexp_extract(max(line) filter (hd), '^(#{1,6})[ \t]+(.+)$', 1)), 0)::int as level, coalesce(trim(regexp_extract(max(line) filter (hd), '^(#{1,6})[ \t]+(.+)$', 2), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), '(No heading)') as title,
  trim(coalesce(string_agg(line, chr(10) order by n) filter (not hd), ''), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) as content, coalesce(max(n) filter (hd), 1)::int as line_start from s where sec_no > 0 or not any_hd group by doc_id, sec_no)"""


@query(_MD + " select doc_id, sec_no, level, title, md5(content) as content_md5, line_start from sec")
def md_sections(spark, folder):
    return chunking.md_sections(markdown(spark, folder)).select("doc_id", "sec_no", "level", "title", F.md5("content").alias("content_md5"), "line_start")


_BLANKS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"


def _packed_sql(name: str, parts: str, keys: str, part: str, close: int = chunking.NEVER, most: int = chunking.MAX_CHARS, out: str = "chunk") -> str:
    """Common table expressions that deal the rows of `parts` (keys, part, size, ...) to chunks: {name} has them with their chunk."""
    on = " and ".join(f"p.{k} = f.{k}" for k in keys.split(", "))
    p_keys = ", ".join(f"p.{k}" for k in keys.split(", "))
    return f"""{name}_i as (select *, row_number() over (partition by {keys} order by {part}) as i from {parts}),
{name}_f({keys}, i, total, open, {out}) as (select {keys}, i, case when size > {most} then 0 else size end, size <= {most} and size < {close}, 1 from {name}_i where i = 1
  union all select {p_keys}, p.i, case when p.size > {most} then 0 when not f.open or f.total + p.size > {most} then p.size else f.total + p.size end, p.size <= {most} and p.size < {close},
    f.{out} + (p.size > {most} or not f.open or f.total + p.size > {most})::int from {name}_f f join {name}_i p on {on} and p.i = f.i + 1),
{name} as (select p.*, f.{out} from {name}_i p join {name}_f f on {on} and p.i = f.i)"""


def _cut_sql(name: str, parts: str, keys: str) -> str:
    """Texts of `parts` (keys, text) cut between paragraphs: {name} has (keys, piece, text, n_pieces)."""
    return f"""{name}_p as (select {keys}, unnest(x) as text, generate_subscripts(x, 1) as para, length(unnest(x)) as size from (select {keys}, string_split(text, chr(10) || chr(10)) as x from {parts})),
{_packed_sql(name + "_d", name + "_p", keys, "para", out="piece")},
{name} as (select *, count(*) over (partition by {keys}) as n_pieces from (select {keys}, piece, string_agg(text, chr(10) || chr(10) order by para) as text from {name}_d group by all))"""


_SECTION_SQL = f"""{_MD.replace("with md", "with recursive md", 1)}, full_ as (select *, length(content) as size from sec where content <> ''),
{_packed_sql("dealt", "full_", "doc_id", "sec_no", chunking.COMBINE_CHARS)},
packed as (select doc_id, chunk, 0 as piece, string_agg(repeat('#', level) || ' ' || title || chr(10) || content, chr(10) || chr(10) order by sec_no) as text, string_agg(title, ' | ' order by sec_no) as sections, arg_min(title, sec_no) as section from dealt where size <= {chunking.MAX_CHARS} group by all),
large as (select doc_id, chunk, title, content as text from dealt where size > {chunking.MAX_CHARS}),
{_cut_sql("pieces", "large", "doc_id, chunk, title")},
whole as (select doc_id, chunk, piece, text, sections, section from packed union all select doc_id, chunk, piece, '## ' || title || case when n_pieces > 1 then ' (continued)' else '' end || chr(10) || text, title, title from pieces)"""


@query(_SECTION_SQL + " select doc_id, (row_number() over (partition by doc_id order by chunk, piece))::int as chunk_num, md5(text) as text_md5, sections, section from whole")
def section_chunks(spark, folder):
    chunks = chunking.chunk_sections(chunking.md_sections(markdown(spark, folder)))
    return chunks.select("doc_id", "chunk_num", F.md5("text").alias("text_md5"), F.array_join("sections", " | ").alias("sections"), "section")


#: Each source's documents, in order, as the pages of one file would be too large to pack in one task; 50 of them are a file here.
def paged(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(F.floor(F.col("doc_id") / 50).alias("doc_id"), (F.col("doc_id") % 50 + 1).cast("int").alias("page_num"), "text")


_PAGE_SQL = f"""with recursive pages_ as (select doc_id // 50 as doc_id, (doc_id % 50 + 1)::int as page_num, text from documents),
full_ as (select *, length(text) as size from (select doc_id, page_num, trim(text, {_BLANKS}) as text from pages_) where text <> ''),
{_packed_sql("dealt", "full_", "doc_id", "page_num")},
packed as (select doc_id, chunk, 0 as piece, string_agg(text, chr(10) || chr(10) order by page_num) as text, min(page_num) as first_, false as over_ from dealt where size <= {chunking.MAX_CHARS} group by doc_id, chunk),
large as (select doc_id, chunk, page_num as first_, text from dealt where size > {chunking.MAX_CHARS}),
{_cut_sql("pieces", "large", "doc_id, chunk, first_")},
whole as (select * from packed union all select doc_id, chunk, piece, text, first_, true from pieces),
chunks as (select doc_id, (row_number() over w)::int as chunk_num, text, (case when over_ then first_ when lag(over_) over w then lag(first_) over w + 1 when row_number() over w = 1 then 1 else first_ end)::int as page_start,
  (case when over_ then first_ else coalesce(lead(first_) over w - 1, last_) end)::int as page_end from whole join (select doc_id, max(page_num) as last_ from pages_ group by doc_id) using (doc_id) window w as (partition by doc_id order by chunk, piece))"""


@query(_PAGE_SQL + " select doc_id, chunk_num, md5(text) as text_md5, page_start, page_end from chunks")
def page_chunks(spark, folder):
    return chunking.chunk_pages(paged(spark, folder)).select("doc_id", "chunk_num", F.md5("text").alias("text_md5"), "page_start", "page_end")


@query(_PAGE_SQL + """ select doc_id, chunk_num, page_start, page_end, exists (select 1 from pages_ p where p.doc_id = chunks.doc_id and p.page_num between page_start and page_end and length(p.text) < 100) as visual,
  case when page_start = page_end then 'page ' || page_start else 'pages ' || page_start || '-' || page_end end as provenance from chunks""")
def page_chunk_provenance(spark, folder):
    pages = paged(spark, folder)
    chunks = chunking.chunk_pages(pages).drop("text")
    return chunking.chunk_provenance(chunks, pages.select("doc_id", "page_num", (F.length("text") < 100).alias("visual")))


@query("""with recursive s as (select conv_id as doc_id, turn as seg_no, turn * 30.0::double as start, text, row_number() over (partition by conv_id order by turn) as i from conversations),
f(doc_id, i, lo, hi, chunk_no) as (select doc_id, i, start, start, 1 from s where i = 1
  union all select s.doc_id, s.i, case when s.start - f.lo > 60 then greatest(0.0, s.start - 30) else f.lo end, case when s.start - f.lo > 60 then s.start else f.hi end, f.chunk_no + (s.start - f.lo > 60)::int from f join s on s.doc_id = f.doc_id and s.i = f.i + 1),
own as (select s.*, f.lo, f.hi, f.chunk_no from s join f using (doc_id, i)), c as (select distinct doc_id, chunk_no, lo, hi from own),
held as (select distinct on (doc_id, chunk_no, seg_no) * from (select doc_id, chunk_no, seg_no, text, lo, start as last_ from own union all select s.doc_id, c.chunk_no, s.seg_no, s.text, c.lo, null from c join s on s.doc_id = c.doc_id and s.start >= c.lo and s.start < c.hi))
select doc_id, chunk_no, min(lo) as start, (select max(start) from own o where o.doc_id = held.doc_id and o.chunk_no = held.chunk_no) as end, coalesce(string_agg(text, ' ' order by seg_no), '') as text from held group by doc_id, chunk_no""")
def transcript_chunks(spark, folder):
    return chunking.chunk_transcript(segments(spark, folder), 60, 30)


_SIZE = r"""with recursive d as (select doc_id, text, length(text) as n from documents where text <> ''),
c(doc_id, start, stop) as (
  select doc_id, 0, case when 2000 >= n then n else (case when length(regexp_extract(substr(text, 1802, 200), '(?s)^.*[\n.!?]')) > 0 then 1801 + length(regexp_extract(substr(text, 1802, 200), '(?s)^.*[\n.!?]')) else 2000 end) end from d
  union all
  select doc_id, s, case when s + 2000 >= n then n else (case when length(regexp_extract(substr(text, s + 1802, 200), '(?s)^.*[\n.!?]')) > 0 then s + 1801 + length(regexp_extract(substr(text, s + 1802, 200), '(?s)^.*[\n.!?]')) else s + 2000 end) end
  from (select d.doc_id, d.text, d.n, greatest(c.start + 1, c.stop - 200) as s from c join d using (doc_id) where c.stop < d.n))"""


@query(_SIZE + " select c.doc_id, (row_number() over (partition by c.doc_id order by start))::int as chunk_num, start::int as start from c")
def size_chunks(spark, folder):
    return chunking.chunk_by_size(table(spark, folder, "documents"), 2000, 200).select("doc_id", "chunk_num", "start")



@query(_SIZE + """, h as (select doc_id, sum(length(trim(substr(text, start + 1, stop - start), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))))::bigint as chunk_chars from c join documents using (doc_id) group by doc_id)
select doc_id, length(text)::bigint as chars, coalesce(chunk_chars, 0)::bigint as chunk_chars, coalesce(coalesce(chunk_chars, 0) < 0.8 * length(text), false) as lost from documents left join h using (doc_id)""")
def content_loss(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return chunking.content_loss(docs, chunking.chunk_by_size(docs, 2000, 200))
