"""Sections and chunks of documents. Parts are packed in order; only their sizes are folded, never their texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

MAX_CHARS, COMBINE_CHARS, NEVER = 16_000, 2_000, 1 << 60
HEADING = r"^(#{1,6})[ \t]+(.+)$"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def _joined(order: str, text: str, by: str = "\n") -> Column:
    """The group's texts in their order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), by)


def md_sections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sec_no, level, title, content, line_start). Text before the first heading is dropped; without headings all is one section."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    lines = lines.withColumn("is_heading", F.col("line").rlike(HEADING))
    by_doc = Window.partitionBy("doc_id")
    lines = lines.withColumns({"sec_no": F.sum(F.col("is_heading").cast("int")).over(by_doc.orderBy("line_no")).cast("int"), "any": F.bool_or("is_heading").over(by_doc)})
    body = F.transform(F.filter(F.array_sort(F.collect_list(F.struct("line_no", "line", "is_heading"))), lambda x: ~x["is_heading"]), lambda x: x["line"])
    heading = F.max(F.when(F.col("is_heading"), F.struct((F.col("line_no") + 1).alias("at"), "line")))
    out = lines.where((F.col("sec_no") > 0) | ~F.col("any")).groupBy("doc_id", "sec_no").agg(heading.alias("h"), strip(F.array_join(body, "\n")).alias("content"))
    return out.select(
        "doc_id", "sec_no", F.coalesce(F.length(F.regexp_extract("h.line", HEADING, 1)), F.lit(0)).alias("level"),
        F.coalesce(strip(F.regexp_extract("h.line", HEADING, 2)), F.lit("(No heading)")).alias("title"), "content", F.coalesce("h.at", F.lit(1)).alias("line_start"),
    )


def _per_row(grouped: DataFrame, keys: list[str], fold, kind: str) -> DataFrame:
    """(keys, out): what a fold makes of the column `rows` of each row, a list of dicts in order; one step after another, in time proportional to the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([fold(rows) for rows in batch.column("rows").to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), made], [*keys, "out"])

    types = {f.name: f.dataType.simpleString() for f in grouped.schema.fields}
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), f"out {kind}"])
    arrow = to_arrow_type(grouped.sparkSession.createDataFrame([], f"out {kind}").schema["out"].dataType)
    return grouped.select(*keys, "rows").mapInArrow(run, schema)


def pack_starts(parts: DataFrame, keys: list[str], part: str, most: int, close: int = NEVER) -> DataFrame:
    """(keys, starts): the parts that begin a chunk. Columns of parts: keys, part, size.

    A part over `most` is a chunk of its own; a part that would take the chunk over `most` begins the next; a part of
    `close` and more ends its chunk.
    """

    def fold(rows: list[dict]) -> list[int]:
        starts, total, open_ = [], 0, False
        for row in rows:
            over = row["size"] > most
            fresh = over or not open_ or total + row["size"] > most
            if fresh:
                starts.append(row["part"])
            total = 0 if over else row["size"] if fresh else total + row["size"]
            open_ = not over and row["size"] < close
        return starts

    rows = F.array_sort(F.collect_list(F.struct(F.col(part).cast("int").alias("part"), F.col("size").cast("long").alias("size"))))
    return _per_row(parts.groupBy(*keys).agg(rows.alias("rows")), keys, fold, "array<int>").withColumnRenamed("out", "starts")


def _dealt(parts: DataFrame, keys: list[str], part: str, most: int, close: int = NEVER, name: str = "chunk") -> DataFrame:
    """Parts with the number of their chunk, from 1, as column `name`."""
    starts = pack_starts(parts, keys, part, most, close)
    return parts.join(starts, keys).withColumn(name, F.size(F.filter("starts", lambda s: s <= F.col(part)))).drop("starts")


def split_paragraphs(parts: DataFrame, keys: list[str], most: int = MAX_CHARS) -> DataFrame:
    """(keys, piece, text, n_pieces): texts cut between paragraphs into pieces of at most `most`; a longer paragraph is one."""
    paragraphs = parts.select(*keys, F.posexplode(F.split("text", "\n\n")).alias("para", "text")).withColumn("size", F.length("text"))
    pieces = _dealt(paragraphs, keys, "para", most, name="piece").groupBy(*keys, "piece").agg(_joined("para", "text", "\n\n").alias("text"))
    return pieces.withColumn("n_pieces", F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def chunk_sections(sections: DataFrame, chunk_size: int = MAX_CHARS, combine: int = COMBINE_CHARS) -> DataFrame:
    """(doc_id, chunk_num, text, sections, section): small sections together, large ones alone, oversize ones cut at paragraphs."""
    most = max(chunk_size, MAX_CHARS)
    full = sections.where(F.col("content") != "").withColumn("size", F.length("content"))
    dealt = _dealt(full, ["doc_id"], "sec_no", most, combine)
    whole = dealt.where(F.col("size") <= most).withColumn("text", F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), "title", F.lit("\n"), "content"))
    packed = whole.groupBy("doc_id", "chunk").agg(_joined("sec_no", "text", "\n\n").alias("text"), F.transform(F.array_sort(F.collect_list(F.struct("sec_no", "title"))), lambda x: x["title"]).alias("sections")).withColumn("piece", F.lit(0))
    large = dealt.where(F.col("size") > most).select("doc_id", "chunk", "title", F.col("content").alias("text"))
    header = F.concat(F.lit("## "), "title", F.when(F.col("n_pieces") > 1, " (continued)").otherwise(""), F.lit("\n"))
    cut = split_paragraphs(large, ["doc_id", "chunk", "title"], most).select("doc_id", "chunk", F.concat(header, "text").alias("text"), F.array("title").alias("sections"), "piece")
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk", "piece"))
    return packed.unionByName(cut).select("doc_id", number.alias("chunk_num"), "text", "sections", F.col("sections")[0].alias("section"))


def chunk_pages(pages: DataFrame, most: int = MAX_CHARS) -> DataFrame:
    """(doc_id, chunk_num, text, page_start, page_end) of pages (doc_id, page_num, text); blank pages are skipped."""
    last = pages.groupBy("doc_id").agg(F.max("page_num").alias("last"))
    full = pages.select("doc_id", "page_num", strip(F.col("text")).alias("text")).where("text <> ''").withColumn("size", F.length("text"))
    dealt = _dealt(full, ["doc_id"], "page_num", most)
    packed = dealt.where(F.col("size") <= most).groupBy("doc_id", "chunk").agg(_joined("page_num", "text", "\n\n").alias("text"), F.min("page_num").alias("first")).withColumns({"piece": F.lit(0), "over": F.lit(False)})
    large = dealt.where(F.col("size") > most).select("doc_id", "chunk", F.col("page_num").alias("first"), "text")
    cut = split_paragraphs(large, ["doc_id", "chunk", "first"], most).select("doc_id", "chunk", "text", "first", "piece", F.lit(True).alias("over"))
    by = Window.partitionBy("doc_id").orderBy("chunk", "piece")
    start = F.when(F.col("over"), F.col("first")).when(F.lag("over").over(by), F.lag("first").over(by) + 1).when(F.row_number().over(by) == 1, 1).otherwise(F.col("first"))
    end = F.when(F.col("over"), F.col("first")).otherwise(F.coalesce(F.lead("first").over(by) - 1, "last"))
    return packed.unionByName(cut).join(last, "doc_id").select("doc_id", F.row_number().over(by).alias("chunk_num"), "text", start.alias("page_start"), end.alias("page_end"))


def chunk_transcript(segments: DataFrame, duration: float = 300, overlap: float = 60) -> DataFrame:
    """(doc_id, chunk_no, start, end, text): spans of time whose beginning repeats the end of the span before."""

    def fold(rows: list[dict]) -> list[dict]:
        chunks, lo = [], 0.0
        for row in rows:
            if not chunks or row["start"] - lo > duration:
                lo = max(0.0, row["start"] - overlap) if chunks else row["start"]
                chunks.append({"at": row["seg_no"], "lo": lo, "hi": row["start"]})
        return chunks

    rows = F.array_sort(F.collect_list(F.struct(F.col("seg_no").cast("int").alias("seg_no"), F.col("start").cast("double").alias("start"))))
    spans = _per_row(segments.where("start is not null").groupBy("doc_id").agg(rows.alias("rows")), ["doc_id"], fold, "array<struct<at:int,lo:double,hi:double>>").withColumnRenamed("out", "chunks")
    placed = F.transform("chunks", lambda c, i: F.struct((i + 1).alias("chunk_no"), c["lo"].alias("lo"), c["hi"].alias("hi"), c["at"].alias("at"), F.get("chunks", i + 1)["at"].alias("stop")))
    own = lambda c: (F.col("seg_no") >= c["at"]) & (c["stop"].isNull() | (F.col("seg_no") < c["stop"]))
    again = lambda c: (F.col("start") >= c["lo"]) & (F.col("start") < c["hi"])
    met = segments.join(spans.select("doc_id", placed.alias("chunks")), "doc_id")
    met = met.select("doc_id", "seg_no", "start", "text", F.explode(F.filter("chunks", lambda c: own(c) | again(c))).alias("c"))
    grouped = met.groupBy("doc_id", F.col("c.chunk_no").alias("chunk_no")).agg(F.min("c.lo").alias("lo"), F.max(F.when(own(F.col("c")), F.col("start"))).alias("end"), _joined("seg_no", "text", " ").alias("text"))
    return grouped.select("doc_id", "chunk_no", F.col("lo").alias("start"), "end", "text")


def chunk_by_size(docs: DataFrame, size: int, overlap: int, id_col: str = "doc_id", text_col: str = "text", back: int = 200, marks: str = "\n.!?") -> DataFrame:
    """(doc_id, chunk_num, start, text): overlapping chunks that end at a mark if one is among the last `back` characters.

    Ends with the chunk that reaches the end of the text. Runs over Arrow batches, since each step depends on the last and a
    text is walked through once.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def spans(text: str) -> Iterator[tuple[int, str]]:
        start = 0
        while start < len(text):
            end = min(start + size, len(text))
            last = end == len(text)
            if not last:
                at = max(text.rfind(m, max(start, end - back) + 1, end + 1) for m in marks)
                end = at + 1 if at >= 0 else end
            yield start, text[start:end].strip()
            if end >= len(text):
                return
            start = max(start + 1, end - overlap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                kept = [s for s in spans(text or "") if s[1]]
                owner = batch.column(0).take(pa.array([i] * len(kept), pa.int64()))
                yield pa.RecordBatch.from_arrays([owner, pa.array(range(1, len(kept) + 1), pa.int32()), pa.array([s[0] for s in kept], pa.int32()), pa.array([s[1] for s in kept], pa.string())], ["doc_id", "chunk_num", "start", "text"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, chunk_num int, start int, text string")


def chunk_markdown(docs: DataFrame, chunk_size: int, overlap: int, preserve_sections: bool = True) -> DataFrame:
    """Chunks by section, or by size alone."""
    return chunk_sections(md_sections(docs), chunk_size) if preserve_sections else chunk_by_size(docs, chunk_size, overlap)


def chunk(rows: DataFrame, mode: str, chunk_size: int = MAX_CHARS, overlap: int = 200) -> DataFrame:
    """Chunks of documents (doc_id, text) by "sections" or "size", or of pages (doc_id, page_num, text) by "pages"."""
    if mode == "pages":
        return chunk_pages(rows, chunk_size)
    if mode not in ("sections", "size"):
        raise ValueError("a mode is sections, size or pages")
    return chunk_markdown(rows, chunk_size, overlap, mode == "sections")


def provenance_label(chunks: DataFrame) -> Column:
    """Where a chunk comes from, by what it has: its pages, its span of characters, its section, or its number."""
    has = set(chunks.columns)
    one = F.col("page_start") == F.col("page_end") if "page_start" in has else None
    forms = []
    if one is not None:
        forms.append(F.when(F.col("page_start").isNotNull(), F.when(one, F.format_string("page %d", "page_start")).otherwise(F.format_string("pages %d-%d", "page_start", "page_end"))))
    if {"start", "text"} <= has:
        forms.append(F.when(F.col("start").isNotNull(), F.format_string("chars %d-%d", F.col("start"), F.col("start") + F.length("text"))))
    if "section" in has:
        forms.append(F.when(F.coalesce("section", F.lit("")) != "", F.concat(F.lit("section: "), "section")))
    return F.coalesce(*forms, F.format_string("chunk %d", "chunk_num"))


def content_loss(docs: DataFrame, chunks: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, chars, chunk_chars, lost): whether a document's chunks hold too little of it."""
    held = chunks.groupBy("doc_id").agg(F.sum(F.length("text")).alias("chunk_chars"))
    out = docs.select("doc_id", F.length("text").cast("long").alias("chars")).join(held, "doc_id", "left").withColumn("chunk_chars", F.coalesce("chunk_chars", F.lit(0).cast("long")))
    return out.withColumn("lost", F.coalesce(F.col("chunk_chars") < least * F.col("chars"), F.lit(False)))


def chunk_provenance(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds provenance and visual to chunks with a span of pages, of pages (doc_id, page_num, visual)."""
    seen = pages.where("visual").select(F.col("doc_id").alias("__doc"), "page_num")
    on = (F.col("doc_id") == F.col("__doc")) & F.col("page_num").between(F.col("page_start"), F.col("page_end"))
    hit = chunks.join(seen, on, "left_semi").select("doc_id", "chunk_num", F.lit(True).alias("visual"))
    return chunks.join(hit, ["doc_id", "chunk_num"], "left").withColumns({"provenance": provenance_label(chunks), "visual": F.coalesce("visual", F.lit(False))})
