"""Rejections, negatives, labels and reports about claims (id, condition, action, drawer, bundle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from .matching import cosines

# Fixed values.
STOPWORDS = ("if", "the", "a", "an", "and", "or", "to", "of", "in", "at", "is", "then")
GATES = ("TEMPORAL", "STRUCTURAL", "RISK")
# Fixed values end.


def by_drawer(c: Column) -> Column:
    """Drawers 1 to 5; all else is 1."""
    number = c.cast("string").try_cast("int")
    return F.when(number.between(1, 5), number).otherwise(1)


def cluster_topics(rows: DataFrame, by: str, order: str, text_col: str, top: int = 3, stopwords: tuple[str, ...] = STOPWORDS) -> DataFrame:
    """(by, topic): the most frequent tokens, the earlier first among equals; GENERAL if there is none.

    Counts are made before rows meet by cluster, so that a large cluster sends each of its tokens once a task.
    """
    found = rows.select(by, order, F.posexplode(tokens(F.col(text_col))).alias("at", "token")).where(~F.col("token").isin(*stopwords))
    counted = found.groupBy(by, "token").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order, "at")).alias("first"))
    ranked = counted.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "first"))).where(F.col("r") <= top)
    labels = ranked.groupBy(by).agg(F.upper(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "token"))), lambda x: x["token"]), "_")).alias("topic"))
    return rows.select(by).distinct().join(labels, by, "left").select(by, F.coalesce("topic", F.lit("GENERAL")).alias("topic"))


def jargon_check(docs: DataFrame, id_col: str, text_col: str, terms: tuple[str, ...], errors: tuple[tuple[str, str], ...]) -> DataFrame:
    """(id, terms_found, n_errors, error_rate): known terms and known misspellings of a text; pairs of equal words are skipped."""
    low = F.lower(text_col)
    hits = lambda words: sum((F.contains(low, F.lit(w.lower())).cast("int") for w in words), F.lit(0))
    out = docs.select(id_col, hits(terms).alias("terms_found"), hits([a for a, b in errors if a != b]).alias("n_errors"))
    return out.withColumn("error_rate", F.bround(F.col("n_errors") / F.greatest("terms_found", F.lit(1)), 4))


def map_source(tier: Column, mapping: tuple[tuple[str, str], ...], parts: tuple[tuple[str, str], ...]) -> Column:
    """The source of a tier by name, else by the first part that the name contains, else null."""
    upper = F.upper(tier)
    out = F.when(F.lit(False), "")
    for name, source in mapping:
        out = out.when(tier == name, source)
    for part, source in parts:
        out = out.when(F.contains(upper, F.lit(part)), source)
    return out


def claims_by_tier(claims: DataFrame, renamed: tuple[tuple[str, str], ...], by_file: tuple[tuple[str, str], ...], otherwise: str) -> DataFrame:
    """(tier, n) of claims (tier, source_file): tiers by their present names; a missing one is told from the file's name."""
    tier, guess = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for old, new in renamed:
        tier = tier.when(F.col("tier") == old, new)
    for pattern, name in by_file:
        guess = guess.when(F.coalesce("source_file", F.lit("")).rlike(pattern), name)
    missing = F.coalesce("tier", F.lit("")).isin("", "UNKNOWN")
    return claims.groupBy(tier.when(missing, guess.otherwise(otherwise)).otherwise(F.col("tier")).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


def record_rejections(rejections: DataFrame, claims: DataFrame) -> DataFrame:
    """Negatives of rejections (rej_id, bundle, signature, reason): with the claim's text where it is known."""
    known = claims.select(F.col("bundle").alias("c_bundle"), F.col("signature").alias("c_signature"), "condition", "action", "drawer")
    latest = known.groupBy("c_bundle", "c_signature").agg(F.min(F.struct("condition", "action", "drawer")).alias("c"))
    met = rejections.join(latest, (F.col("bundle") == F.col("c_bundle")) & (F.col("signature") == F.col("c_signature")), "left")
    full = F.concat("reason", F.lit(" Original: "), "c.condition", F.lit(" -> "), "c.action")
    return met.select("rej_id", F.lit("NEGATIVE").alias("type"), F.when(F.col("c").isNull(), F.col("reason")).otherwise(F.substring(full, 1, 500)).alias("reason"), "bundle", "signature", F.col("c.drawer").alias("drawer"))


def attach_negatives(rows: DataFrame, negatives: DataFrame, last: int = 10) -> DataFrame:
    """Adds the ids and reasons of the last negatives (id, ord, reason) to every row; they are at most `last`."""
    recent = negatives.orderBy(F.desc("ord"), F.desc("id")).limit(last)
    ordered = F.array_sort(F.collect_list(F.struct("ord", "id", "reason")))
    one = recent.agg(F.transform(ordered, lambda x: x["id"]).alias("negative_ids"), F.array_join(F.transform(ordered, lambda x: F.concat(x["id"].cast("string"), F.lit(": "), x["reason"])), "\n").alias("negatives"))
    return rows.join(F.broadcast(one), F.lit(True), "left")


def reset(queue: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition go back to QUEUED, without a bundle."""
    return queue.withColumns({"bundle_id": F.when(condition, F.lit(None)).otherwise(F.col("bundle_id")), "status": F.when(condition, "QUEUED").otherwise(F.col("status"))})


def diversity(calls: DataFrame, by: str, order: str) -> DataFrame:
    """(by, diverse): whether the last extractor and the last auditor are of different families; both have to be there."""
    last = lambda role: F.max_by(F.when(F.col("role") == role, F.col("family")), F.when(F.col("role") == role, F.col(order)))
    out = calls.groupBy(by).agg(last("extractor").alias("extractor"), last("auditor").alias("auditor"))
    return out.withColumn("diverse", F.coalesce(F.col("extractor") != F.col("auditor"), F.lit(False)))


def seq_id(prefix: str, partition: list[str], order: list[str]) -> Column:
    return F.format_string(f"{prefix}-%03d", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


def semantic_match(docs: DataFrame, vectors: DataFrame, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pattern_id, similarity): cosine of term frequencies of texts and patterns, of any number; rows that share an id are one text each."""
    words = lambda c: tokens(F.col(c)).alias("words")
    lines = vectors.select(F.col("id").alias("line_id"), words("pattern"))
    met = cosines(docs.select(id_col, words(text_col)), id_col, "words", lines, threshold)
    return met.select(id_col, F.col("line_id").alias("pattern_id"), F.round("similarity", 4).alias("similarity"))


def explode_results(results: DataFrame) -> DataFrame:
    """(doc_id, drawer, concept_id, status) of results (doc_id, drawer, error, concepts: array of concept_id, status); errors are skipped."""
    return results.where(F.col("error").isNull()).select("doc_id", "drawer", F.inline("concepts"))


def render_bundles(signatures: DataFrame, by: str, order: str, phrases: tuple[str, ...] = ()) -> DataFrame:
    """(bundle, text, n, bleed): a Markdown document of a bundle's signatures, and the forbidden phrases that it contains.

    White space in a cell becomes one space, and a bar is escaped, so that each signature is one line.
    """
    from .rules import narrative_violations

    cell = lambda c: F.regexp_replace(F.replace(F.col(c), F.lit("|"), F.lit("\\|")), r"[ \t\n\x0B\f\r]+", " ")
    line = F.concat_ws(" | ", cell("id"), cell("condition"), cell("action"))
    ordered = F.array_sort(F.collect_list(F.struct(order, F.concat(F.lit("| "), line, F.lit(" |")).alias("line"))))
    table = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    head = "## SIGNATURES\n\n| ID | Condition | Action |\n|---|---|---|\n"
    out = signatures.groupBy(by).agg(F.concat(F.lit("# BUNDLE "), F.first(F.col(by).cast("string")), F.lit("\n\n" + head), table, F.lit("\n")).alias("text"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("bleed", narrative_violations(F.col("text"), phrases, True) if phrases else F.array().cast("array<string>"))


def parse_bundles(bundles: DataFrame, by: str) -> DataFrame:
    """(bundle, id, condition, action, error): the signature rows of bundle documents; one with too few cells has an error, and null for those that it lacks."""
    lines = bundles.select(by, F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(r"^\| S-\d+ \|"))
    cells = F.split(F.regexp_replace("line", r" \|$", ""), r" \| ")
    cell = lambda i: F.trim(F.replace(F.get(cells, F.lit(i)), F.lit("\\|"), F.lit("|")))
    error = F.when(F.size(cells) < 3, F.format_string("%d of 3 cells", F.size(cells)))
    return lines.select(by, F.regexp_extract("line", r"^\| (S-\d+) \|", 1).alias("id"), cell(1).alias("condition"), cell(2).alias("action"), error.alias("error"))


def _first_ids(clusters: DataFrame, first: int) -> DataFrame:
    """(drawer, root, topic, n, ids): clusters with their size and first ids, ranked before they meet in a row."""
    keys = ["drawer", "root", "topic"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
    ids = clusters.withColumn("id", F.col("id").cast("string")).withColumn("r", place).where(F.col("r") <= first)
    listed = ids.groupBy(*keys).agg(F.array_sort(F.collect_list("id")).alias("ids"))
    sizes = clusters.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumnsRenamed({k: f"of_{k}" for k in keys})
    met = sizes.join(listed, F.col("of_drawer").eqNullSafe(F.col("drawer")) & F.col("of_root").eqNullSafe(F.col("root")) & F.col("of_topic").eqNullSafe(F.col("topic")))
    return met.select(*keys, "n", "ids")


def render_theory(clusters: DataFrame, negatives: DataFrame, first: int = 10) -> DataFrame:
    """(drawer, text): a line for each cluster (drawer, root, topic, id) with its size and first ids, then the number of negatives."""
    lines = _first_ids(clusters, first)
    line = F.format_string("- %s (%d): %s", "topic", "n", F.array_join("ids", ", "))
    told = lines.groupBy("drawer").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("root", line.alias("line")))), lambda x: x["line"]), "\n").alias("body"))
    lost = negatives.groupBy("drawer").agg(F.count(F.lit(1)).alias("n"))
    return told.join(lost, "drawer", "left").select("drawer", F.concat(F.lit("## "), F.col("drawer").cast("string"), F.lit("\n"), "body", F.format_string("\n%d negatives\n", F.coalesce("n", F.lit(0).cast("long")))).alias("text"))


def theory_index(clusters: DataFrame, names: dict[int, str] | None = None, first: int = 5) -> DataFrame:
    """(drawer, root, line): the index line of each cluster (drawer, root, topic, id), with its first ids; names are those of drawers."""
    name = F.format_string("Drawer %d", F.col("drawer").cast("int"))
    if names:
        name = F.coalesce(F.get(F.map_values(F.map_filter(F.create_map(*(x for k, v in names.items() for x in (F.lit(k), F.lit(v)))), lambda k, _: k == F.col("drawer"))), 0), name)
    more = F.when(F.col("n") > first, "...").otherwise("")
    line = F.concat(F.lit("- **"), name, F.lit("** | CLUSTER: "), "topic", F.lit(" | Entries: "), F.array_join("ids", ", "), more)
    return _first_ids(clusters, first).select("drawer", "root", line.alias("line"))


def theory_totals(clusters: DataFrame, negatives: DataFrame) -> DataFrame:
    """One row (entries, clusters, negatives) of the footer."""
    counted = clusters.groupBy("drawer", "root").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("entries"), F.count(F.lit(1)).alias("clusters"))
    return counted.join(negatives.agg(F.count(F.lit(1)).alias("negatives")), F.lit(True))


def negative_events(rejections: DataFrame, at: str, start: int = 0) -> DataFrame:
    """Event rows of rejections (rej_id, reason, signature, bundle, claim, drawer, rejected_by, original), numbered N-001 on from `start` in the order of rej_id; columns that lack have none.

    They are what sinks.append_events appends; numbers come by ranges, not from one task.
    """
    from .ordinal import with_ordinal

    has = set(rejections.columns)
    text = lambda c, default="": F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in has else F.lit(default)
    numbered = with_ordinal(rejections.select("rej_id").distinct(), [F.col("rej_id")], "n")
    entries = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (
        ("source_signature", text("signature")), ("source_bundle", text("bundle")), ("source_claim_id", text("claim")), ("drawer", text("drawer")), ("rejected_by", text("rejected_by", "auditor")), ("original_reason", text("original")), ("recorded_at", F.lit(at)),
    ))), lambda e: e["value"] != ""))
    return rejections.join(numbered, "rej_id").select(
        F.format_string("N-%03d", F.col("n") + start).alias("id"), F.lit("NEGATIVE").alias("type"), F.lit(None).cast("string").alias("content"), text("bundle").alias("source"), F.lit(at).alias("timestamp"), F.col("reason"), entries.alias("metadata"),
    )


def cluster_report(catalogue: DataFrame, top: int = 5) -> DataFrame:
    """(category, rank, line): of each category (category, ord, title, url, view_count, duration, topics) the most viewed, with views, minutes and topics."""
    place = F.row_number().over(Window.partitionBy("category").orderBy(F.coalesce("view_count", F.lit(0)).desc(), "ord"))
    best = catalogue.withColumn("rank", place).where(F.col("rank") <= top)
    views = F.format_number(F.coalesce("view_count", F.lit(0)), 0)
    minutes = F.floor(F.coalesce("duration", F.lit(0)) / 60).cast("long").cast("string")
    topics = F.when(F.size("topics") > 0, F.concat(F.lit(" ["), F.array_join("topics", ", "), F.lit("]"))).otherwise("")
    line = F.concat(F.lit("- ["), F.substring(F.coalesce(F.nullif("title", F.lit("")), F.lit("?")), 1, 60), F.lit("]("), F.coalesce("url", F.lit("")), F.lit(") — "), views, F.lit(" views, "), minutes, F.lit("min"), topics)
    return best.select("category", "rank", line.alias("line"))


def topic_report(catalogue: DataFrame) -> DataFrame:
    """(topic, n, place): topics by falling count, then by name."""
    from .ordinal import with_ordinal

    counted = catalogue.select(F.explode("topics").alias("topic")).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return with_ordinal(counted, [F.desc("n"), F.col("topic")], "place")


def capped_listing(claims: DataFrame, most: int) -> DataFrame:
    """(pos, drawer, line): claims (ord, drawer, condition, action, source_file) by drawer, a null one being 0, and within it in order; `most` in all, then a line with the number of those left out.

    Only the first are sorted, and counts are of all.
    """
    from .ordinal import with_ordinal

    rows = claims.withColumn("drawer", F.coalesce(F.col("drawer").cast("int"), F.lit(0)))
    first = with_ordinal(rows.orderBy("drawer", "ord").limit(most), [F.col("drawer"), F.col("ord")], "pos")
    line = F.concat(F.lit("- IF "), F.coalesce("condition", F.lit("")), F.lit(" → THEN "), F.coalesce("action", F.lit("")), F.lit(" ("), F.coalesce("source_file", F.lit("unknown")), F.lit(")"))
    left = rows.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    more = left.select(F.lit(most + 1).cast("long").alias("pos"), F.lit(None).cast("int").alias("drawer"), F.format_string("... and %d more claims truncated", F.col("n") - most).alias("line"))
    return first.select("pos", "drawer", line.alias("line")).unionByName(more)


def plan_queue(queue: DataFrame, limit: int | None = None, dry_run: bool = False) -> DataFrame:
    """Queue rows (id, status, url, position, ...) with the action of a run: only QUEUED rows are pending, the first `limit` of them by position are taken.

    Of these, one without an address is a `skip`, the others a `run`, or `dry_run`; pending rows beyond the limit `wait`, all others are `done`. Only pending keys are sorted.
    """
    from .ordinal import with_ordinal

    pending = F.col("status") == "QUEUED"
    place = with_ordinal(queue.where(pending).select("id", "position"), [F.col("position"), F.col("id")], "__place").select("id", "__place")
    taken = F.lit(True) if not limit else F.col("__place") <= limit
    bare = F.coalesce("url", F.lit("")) == ""
    action = F.when(F.col("__place").isNull(), "done").when(~taken, "wait").when(bare, "skip").otherwise("dry_run" if dry_run else "run")
    return queue.join(place, "id", "left").withColumn("action", action).drop("__place")


def render_notes(pairs: DataFrame, negatives: DataFrame, most: int = 20) -> DataFrame:
    """One row of text: the first redundant pairs (a, b, similarity), then the last negatives (id, ord, reason); `most` of each."""
    pair = F.format_string("- %s = %s (%.2f)", F.col("a").cast("string"), F.col("b").cast("string"), F.col("similarity"))
    first = pairs.orderBy("a", "b").limit(most).agg(F.array_sort(F.collect_list(F.struct("a", "b", pair.alias("line")))).alias("p"))
    last = negatives.orderBy(F.desc("ord"), F.desc("id")).limit(most).agg(F.array_sort(F.collect_list(F.struct("ord", "id", F.concat(F.lit("- "), F.col("id").cast("string"), F.lit(" | "), "reason").alias("line")))).alias("n"))
    lines = lambda c: F.array_join(F.transform(c, lambda x: x["line"]), "\n")
    return first.join(F.broadcast(last), F.lit(True), "left").select(F.concat(F.lit("## REDUNDANT\n"), lines("p"), F.lit("\n## NEGATIVES\n"), lines("n"), F.lit("\n")).alias("text"))


def run_summary(results: DataFrame, still_pending: DataFrame) -> DataFrame:
    """One row (total_pending, processed, failed, skipped) of the results of a run (id, status) and the rows that still wait (id)."""
    of = lambda s: F.count_if(F.col("status") == s)
    counted = results.agg(of("DONE").alias("processed"), of("FAILED").alias("failed"), of("SKIPPED").alias("skipped"))
    waiting = still_pending.agg(F.count(F.lit(1)).alias("total_pending"))
    return waiting.unionByName(counted, allowMissingColumns=True).agg(*(F.max(c).alias(c) for c in [*waiting.columns, *counted.columns]))


def yield_summary(docs: DataFrame, signatures: DataFrame, by: str) -> DataFrame:
    """(by, files, with_signatures, zero_yield, extracted, validated, rejected) of documents (id, by) and audited signatures (id, verdict)."""
    of = signatures.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == "REJECT").alias("bad"))
    n, bad = F.coalesce("n", F.lit(0).cast("long")), F.coalesce("bad", F.lit(0).cast("long"))
    met = docs.join(of, "id", "left").groupBy(by)
    return met.agg(F.count(F.lit(1)).alias("files"), F.count_if(n > 0).alias("with_signatures"), F.count_if(n == 0).alias("zero_yield"), F.sum(n).alias("extracted"), F.sum(n - bad).alias("validated"), F.sum(bad).alias("rejected"))


ATTEMPTS = 3


def _table(cells: Column, none: str) -> Column:
    """The lines of a Markdown table of an array of arrays of cells, or the line for none."""
    clean = lambda c: F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), r"[ \t\n\x0B\f\r]+", " ")
    lines = F.transform(cells, lambda row: F.concat(F.lit("| "), F.array_join(F.transform(row, clean), " | "), F.lit(" |")))
    return F.when(F.size(cells) > 0, F.array_join(lines, "\n")).otherwise(none)


def render_evidence(bundles: DataFrame, phrases: tuple[str, ...] = ()) -> DataFrame:
    """Adds text, novel and bleed to bundles (bundle_id, source, span, signatures, deltas, gates, results, auditor, negatives).

    signatures: array of (id, condition, action, at); deltas: (parameter, current, value, change); gates: (name, status, notes), by default all pending;
    results: (id, verdict, reason) of the audit; negatives: ids. bleed lists the forbidden phrases outside of tables.
    """
    from .rules import narrative_violations

    rows = lambda c, *names: F.transform(F.coalesce(c, F.array()), lambda x: F.array(*(x[n].cast("string") for n in names)))
    default = F.array(*(F.struct(F.lit(g).alias("name"), F.lit("PENDING").alias("status"), F.lit("").alias("notes")) for g in GATES))
    gates = F.transform(F.coalesce("gates", default), lambda x: F.array(F.upper(x["name"]), F.coalesce(x["status"], F.lit("PENDING")), F.coalesce(x["notes"], F.lit(""))))
    rejected = F.filter("results", lambda x: x["verdict"] == "REJECT")
    passed = F.size("results") - F.size(rejected)
    novel = F.size(F.filter(F.coalesce("deltas", F.array().cast("array<struct<parameter:string,current:string,value:string,change:string>>")), lambda x: F.coalesce(x["change"], F.lit("NEW")) == "NEW"))
    reasons = F.when(F.size(rejected) > 0, F.array_join(F.transform(rejected, lambda x: F.concat(F.lit("- "), x["id"], F.lit(": "), F.coalesce(x["reason"], F.lit("")))), "\n")).otherwise("- None")
    statement = F.when(F.size(rejected) > 0, F.format_string("%d signatures rejected", F.size(rejected))).otherwise(f"No falsification found after {ATTEMPTS} attempts")
    negatives = F.coalesce(F.nullif(F.array_join("negatives", ", "), F.lit("")), F.lit("none"))
    # The lines of the document.
    text = F.concat(
        F.lit("# EVIDENCE BUNDLE: "), "bundle_id", F.lit("\n## Source: "), "source", F.lit(" @ "), "span",
        F.lit("\n\n### IF-THEN SIGNATURES\n| ID | Condition (IF) | Action (THEN) | Source Timestamp |\n|----|----|----|----|\n"), _table(rows(F.col("signatures"), "id", "condition", "action", "at"), "| — | No validated signatures | — | — |"),
        F.lit("\n\n### DELTA TO CANON\n| Parameter | Current | This Bundle | Change Type |\n|----|----|----|----|\n"), _table(rows(F.col("deltas"), "parameter", "current", "value", "change"), "| — | — | — | — |"),
        F.format_string("\n\n**Novelty:** %d net-new parameters\n\n### AUDITOR VERDICT\n- Signatures validated: %d\n- Signatures rejected: %d\n- Rejection reasons:\n", novel, passed, F.size(rejected)), reasons,
        F.lit(f"\n- Falsification attempts: {ATTEMPTS}\n- Statement: "), statement,
        F.lit("\n\n### GATES PASSED\n| Gate | Status | Notes |\n|----|----|----|\n"), _table(gates, "| — | PENDING | — |"),
        F.lit("\n\n### PROVENANCE\n- Auditor model: ["), F.coalesce("auditor", F.lit("pending")), F.lit("]\n- Negatives considered: ["), negatives, F.lit("]\n"),
    )
    # Fixed values end.
    out = bundles.withColumns({"text": text, "novel": novel})
    return out.withColumn("bleed", narrative_violations(F.col("text"), phrases, True) if phrases else F.array().cast("array<string>"))


def parse_evidence(bundles: DataFrame) -> DataFrame:
    """(bundle_id, validated, rejected, auditor, negatives) of the texts of bundle documents."""
    found = lambda pattern: F.nullif(F.regexp_extract("text", pattern, 1), F.lit(""))
    number = lambda name: found(rf"(?m)^- {name}: (\d+)$").cast("int")
    return bundles.select(
        found(r"(?m)^# EVIDENCE BUNDLE: (.+)$").alias("bundle_id"), number("Signatures validated").alias("validated"), number("Signatures rejected").alias("rejected"),
        found(r"(?m)^- Auditor model: \[(.*)\]$").alias("auditor"), found(r"(?m)^- Negatives considered: \[(.*)\]$").alias("negatives"),
    )
