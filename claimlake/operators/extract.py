"""IF/THEN extraction from segments (doc_id, seg_no, start, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import fmt_ts, norm_key
from ..sources.shared import materialise
from .joins import exclude_negatives
from .rules import confidence


def _matches(text: str, patterns: tuple[str, ...], gates: tuple[str, ...]):
    """All matches of all patterns, pattern by pattern: (pattern_no, match_no, condition, action).

    A text is searched for a pattern only if the pattern's gate matches.
    """
    parts = []
    for i, (pattern, gate) in enumerate(zip(patterns, gates, strict=True)):
        # whole matches first, whose groups are then told from the matches alone: a lazy search of the text is dear
        whole = F.when(F.col(text).rlike(gate), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
        parts.append(F.transform(whole, _groups(i, pattern)))
    return F.explode(F.concat(*parts))


def _groups(number: int, pattern: str):
    side = lambda match, group: F.trim(F.regexp_extract(match, pattern, group))
    return lambda match, at: F.struct(F.lit(number).alias("pattern_no"), at.alias("match_no"), side(match, 1).alias("condition"), side(match, 2).alias("action"))


def extract_segments(segments: DataFrame, patterns: tuple[str, ...] = L.IF_THEN_PATTERNS, gates: tuple[str, ...] = L.IF_THEN_GATES, negatives: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One signature for each match in a segment that no negative excludes; ids run over the document. Columns in `keep` go along; texts don't."""
    about = ["doc_id", "seg_no", *keep, fmt_ts(F.col("start")).alias("source_timestamp"), F.substring("text", 1, 200).alias("source_quote"), confidence(F.col("text")).alias("confidence")]
    found = segments.select(*about, _matches("text", patterns, gates).alias("m")).select("*", "m.*").drop("m")
    found = found if negatives is None else exclude_negatives(found, negatives)
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("seg_no", "pattern_no", "match_no"))
    return found.select(
        "doc_id", F.format_string("S-%03d", number).alias("id"), F.concat(F.lit("IF "), "condition").alias("condition"), F.concat(F.lit("THEN "), "action").alias("action"),
        "source_timestamp", "source_quote", "confidence", *keep,
    )


def extract_windowed(segments: DataFrame, sizes: tuple[int, ...] = (3, 5, 7), least: int = 15, patterns: tuple[str, ...] = L.IF_THEN_PATTERNS, gates: tuple[str, ...] = L.IF_THEN_GATES, negatives: DataFrame | None = None) -> DataFrame:
    """Matches in windows of consecutive segments; of equal conditions the longest action stays, in the first one's place.

    Segments are read and sorted once for all sizes: each gets the texts of its longest window, of which the others are the first.
    """
    over = Window.partitionBy("doc_id").orderBy("seg_no").rowsBetween(0, max(sizes) - 1)
    following = segments.select("doc_id", "seg_no", "start", F.collect_list(F.struct("text")).over(over).alias("following"))
    texts = F.col("following.text")
    each = F.array(*(F.struct(F.lit(i).alias("size_no"), F.when(F.size(texts) >= size, F.array_join(F.slice(texts, 1, size), " ")).alias("text")) for i, size in enumerate(sizes)))
    windows = following.select("doc_id", "seg_no", "start", F.explode(each).alias("w")).select("doc_id", "seg_no", "start", "w.size_no", "w.text")
    found = windows.select("doc_id", "seg_no", "size_no", "start", F.substring("text", 1, 200).alias("quote"), _matches("text", patterns, gates).alias("m")).select("doc_id", "seg_no", "size_no", "start", "quote", "m.*")
    found = found.where((F.length("condition") >= least) & (F.length("action") >= least))
    place = F.struct("size_no", "seg_no", "pattern_no", "match_no")
    best = F.struct(-F.length("action"), place.alias("place"))
    kept = found.groupBy("doc_id", norm_key(F.col("condition")).alias("key")).agg(F.min(place).alias("slot"), F.min_by(F.struct("condition", "action", "start", "quote"), best).alias("won")).select("doc_id", "slot", "won.*")
    kept = kept if negatives is None else exclude_negatives(kept, negatives)
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("slot"))
    return kept.select(
        "doc_id", F.format_string("S-%03d", number).alias("id"), F.concat(F.lit("IF "), "condition").alias("condition"), F.concat(F.lit("THEN "), "action").alias("action"),
        fmt_ts(F.col("start")).alias("source_timestamp"), F.col("quote").alias("source_quote"), confidence(F.concat_ws(" ", "condition", "action")).alias("confidence"),
    )


def extract(segments: DataFrame, negatives: DataFrame | None = None, windowing: dict | None = None, **windowed) -> DataFrame:
    """Documents of many short segments by windows, all others segment by segment; the keywords go to the two choices.

    The ids of the former are written first, so that their size is known when segments meet them: a table of few ids is broadcast, and no text is shuffled for it.
    """
    short = materialise(needs_windowing(segments, **(windowing or {})).where("windowed").select("doc_id"), "short")
    whole = extract_segments(segments.join(short, "doc_id", "left_anti"), negatives=negatives)
    return whole.unionByName(extract_windowed(segments.join(short, "doc_id", "left_semi"), negatives=negatives, **windowed))


def needs_windowing(segments: DataFrame, least: int = 20, length: float = 60, first: int = 50) -> DataFrame:
    """Whether a document has many short segments."""
    grouped = segments.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("seg_no") < first, F.length("text"))).alias("mean_length"))
    return grouped.select("doc_id", "n", ((F.col("n") >= least) & (F.col("mean_length") < length)).alias("windowed"))
