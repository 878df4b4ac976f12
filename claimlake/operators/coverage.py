"""Coverage of concepts by sources: upgrades, summaries and gaps. Statuses rise from PENDING over ABSENT and PARTIAL to FOUND."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("PENDING", "ABSENT", "PARTIAL", "FOUND")
#: All that a summary counts; what is not applicable is never upgraded from or to.
COUNTED = (*STATUSES, "NOT_APPLICABLE")


def rank_of(status: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STATUSES)), status)


def upgrade_ranked(observations: DataFrame) -> DataFrame:
    """(concept_id, source, status, documents): the highest status, and the documents that show it in part or whole."""
    shown = F.when(F.col("status").isin("PARTIAL", "FOUND"), F.col("document"))
    return observations.groupBy("concept_id", "source").agg(F.max_by("status", rank_of(F.col("status"))).alias("status"), F.array_sort(F.collect_set(shown)).alias("documents"))


def upgrade_sticky(observations: DataFrame) -> DataFrame:
    """FOUND wins; otherwise the first status other than PENDING stays."""
    told = F.when(F.col("status") != "PENDING", F.col("status"))
    first = F.min_by(told, F.when(told.isNotNull(), F.col("ord")))
    return observations.groupBy("concept_id", "source").agg(F.when(F.bool_or(F.col("status") == "FOUND"), "FOUND").otherwise(F.coalesce(first, F.lit("PENDING"))).alias("status"))


def _evidence_of(cells: DataFrame) -> DataFrame:
    """Cells (concept_id, source, status) with their lists of evidence; those that lack a column have none."""
    lists = {"signature_ids": "array<string>", "documents": "array<string>", "timestamps": "array<string>"}
    return cells.select("concept_id", "source", F.coalesce("status", F.lit("PENDING")).alias("status"), *((F.coalesce(F.col(c), F.array()) if c in cells.columns else F.array()).cast(kind).alias(c) for c, kind in lists.items()))


def upgrade_ranked_with_evidence(cells: DataFrame, observations: DataFrame, prefix: str) -> DataFrame:
    """Cells (concept_id, source, status, signature_ids, documents, timestamps) after observations (concept_id, source, ord, status, document, timestamp) in their order.

    An observation of a higher status than all before it upgrades its cell; any status but FOUND and PARTIAL counts as ABSENT. An upgrade to PARTIAL or FOUND appends the signature id
    prefix-concept-n, adds the document, and sets the time; one to ABSENT leaves no evidence. Observations without a cell are ignored. A cell's upgrades are the first observations of each rank or
    more, which are aggregates, so that a cell with many observations meets in parts.
    """
    rank = F.when(F.col("status") == "FOUND", 3).when(F.col("status") == "PARTIAL", 2).otherwise(1)
    seen = F.struct("ord", F.col("document").cast("string").alias("document"), F.col("timestamp").cast("string").alias("timestamp"), rank.alias("rank"))
    firsts = observations.groupBy("concept_id", "source").agg(*(F.min(F.when(rank >= r, seen)).alias(f"first{r}") for r in (1, 2, 3)))
    met = _evidence_of(cells).join(firsts, ["concept_id", "source"], "left")
    held = F.when(F.col("status") == "FOUND", 3).when(F.col("status") == "PARTIAL", 2).when(F.col("status") == "ABSENT", 1).otherwise(0)
    # an upgrade to PARTIAL or FOUND is the first of that rank or more, if the cell wasn't there; the two may be one
    upgrades = F.array_distinct(F.filter(F.array(*(F.when(held < r, F.col(f"first{r}")) for r in (2, 3))), lambda x: x.isNotNull()))
    met = met.withColumns({"held": held, "up": upgrades})
    to_absent = (F.col("held") < 1) & F.col("first1").isNotNull() & (F.size("up") == 0)
    last = F.element_at("up", -1)
    ids = F.transform("up", lambda _, i: F.concat_ws("-", F.lit(prefix), "concept_id", (F.size("signature_ids") + i + 1).cast("string")))
    none = F.array().cast("array<string>")
    grown = lambda new, old: F.when(F.size("up") > 0, new).when(to_absent, none).otherwise(F.col(old)).alias(old)
    documents = F.array_sort(F.array_distinct(F.concat("documents", F.filter(F.transform("up", lambda x: x["document"]), lambda d: d.isNotNull()))))
    times = F.when(F.coalesce(last["timestamp"], F.lit("")) == "", none).otherwise(F.array(last["timestamp"]))
    status = F.when(F.size("up") > 0, F.when(last["rank"] == 3, "FOUND").otherwise("PARTIAL")).when(to_absent, "ABSENT").otherwise(F.col("status")).alias("status")
    return met.select("concept_id", "source", status, grown(F.concat("signature_ids", ids), "signature_ids"), grown(documents, "documents"), grown(times, "timestamps"))


def sticky_signatures(cells: DataFrame, observations: DataFrame, prefix: str) -> DataFrame:
    """(concept_id, source, ord, signature_id) of the FOUND observations (concept_id, source, ord, signature, ...) that have a signature, numbered on from those their cell has.

    A row each, numbered by running totals, so that a cell may have any number of them. ord is unique within a cell.
    """
    from .ordinal import running_total

    held = _evidence_of(cells).select("concept_id", "source", F.size("signature_ids").alias("held"))
    signed = observations.where("status = 'FOUND' and coalesce(signature, '') <> ''").join(held, ["concept_id", "source"]).select("concept_id", "source", "ord", "held", F.struct("concept_id", "source").alias("cell"))
    counted = running_total(signed, "cell", ["ord"], F.lit(1), "n")
    return counted.select("concept_id", "source", "ord", F.concat_ws("-", F.lit(prefix), "concept_id", (F.col("held") + F.col("n")).cast("string")).alias("signature_id"))


def upgrade_sticky_with_evidence(cells: DataFrame, observations: DataFrame) -> DataFrame:
    """Cells (concept_id, source, status, n_signatures, documents) after observations (concept_id, source, ord, status, document, signature) in their order.

    FOUND wins, the first PARTIAL or ABSENT replaces PENDING alone. Each FOUND appends its document, once, and counts its signature if it has one; sticky_signatures has their ids.
    Documents meet as distinct names. Observations without a cell are ignored.
    """
    keys = ["concept_id", "source"]
    told = F.when(F.col("status").isin("PARTIAL", "ABSENT"), F.struct("ord", "status"))
    found = F.col("status") == "FOUND"
    status = observations.groupBy(*keys).agg(F.bool_or(found).alias("found"), F.min(told).alias("first"), F.count_if(found & (F.coalesce("signature", F.lit("")) != "")).alias("signed"))
    names = observations.where(found).select(*keys, "ord", F.col("document").cast("string").alias("document")).where("document <> ''").groupBy(*keys, "document").agg(F.min("ord").alias("ord"))
    listed = names.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "document"))), lambda x: x["document"]).alias("new"))
    met = _evidence_of(cells).join(status, keys, "left").join(listed, keys, "left")
    now = F.when(F.coalesce("found", F.lit(False)), "FOUND").when((F.col("status") == "PENDING") & F.col("first").isNotNull(), F.col("first.status")).otherwise(F.col("status"))
    count = F.size("signature_ids") + F.coalesce("signed", F.lit(0))
    return met.select(*keys, now.alias("status"), count.cast("long").alias("n_signatures"), F.array_union("documents", F.coalesce("new", F.array().cast("array<string>"))).alias("documents"))


def grade_counts(concepts: DataFrame) -> DataFrame:
    """(grade, n, of) of concepts (concept_id, grade); a concept without a grade counts as UNKNOWN."""
    counted = concepts.groupBy(F.coalesce("grade", F.lit("UNKNOWN")).alias("grade")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(F.broadcast(concepts.agg(F.count(F.lit(1)).alias("of"))), F.lit(True), "left")


def from_claims(cells: DataFrame, matches: DataFrame) -> DataFrame:
    """Cells (concept_id, source, status, signature_ids, bundles, documents) after the claims that were matched to their concepts.

    matches: (concept_id, source, ord, signature_id, bundle, document). A cell with a match is FOUND; each new name is appended to its
    list once, in order. Matches without a cell are ignored, before any list is made. Names are made distinct before they meet in a cell.
    """
    from .joins import lookup

    matches = matches.join(lookup(cells.select("concept_id", "source").distinct()), ["concept_id", "source"], "left_semi")
    lists = {"signature_ids": "signature_id", "bundles": "bundle", "documents": "document"}
    names = F.array(*(F.struct(F.lit(to).alias("list"), F.col(c).cast("string").alias("name")) for to, c in lists.items()))
    each = matches.select("concept_id", "source", "ord", F.inline(names)).where("name <> ''").groupBy("concept_id", "source", "list", "name").agg(F.min("ord").alias("ord"))
    ordered = lambda to: F.transform(F.array_sort(F.collect_list(F.when(F.col("list") == to, F.struct("ord", "name")))), lambda x: x["name"])
    found = each.groupBy("concept_id", "source").agg(*(ordered(to).alias(f"new_{to}") for to in lists))
    some = matches.select("concept_id", "source").distinct().withColumn("matched", F.lit(True))
    met = cells.join(some, ["concept_id", "source"], "left").join(found, ["concept_id", "source"], "left")
    grown = lambda to: F.array_union(F.coalesce(to, F.array().cast("array<string>")), F.coalesce(f"new_{to}", F.array().cast("array<string>")))
    return met.select("concept_id", "source", F.when(F.col("matched"), "FOUND").otherwise(F.col("status")).alias("status"), *(grown(to).alias(to) for to in lists))


def coverage_summary(cells: DataFrame) -> DataFrame:
    """Counts of cells (concept_id, source, drawer, status) by status, all of which appear, by drawer, by source and in total, in one pass; a null drawer or source is unknown."""
    grouped = cells.withColumn("status_of", F.col("status")).groupingSets([[F.col("status")], [F.col("drawer")], [F.col("source")], []], "status", "drawer", "source")
    kind = F.when(F.grouping("status") == 0, "status").when(F.grouping("drawer") == 0, "drawer").when(F.grouping("source") == 0, "source").otherwise("total")
    counts = grouped.agg(kind.alias("dimension"), F.count(F.lit(1)).alias("total"), F.count_if(F.col("status_of") == "FOUND").alias("found"))
    counts = counts.select("dimension", F.when(F.col("dimension") == "total", "all").otherwise(F.coalesce("status", "drawer", "source", F.lit("unknown"))).alias("value"), "total", "found")
    none = cells.sparkSession.range(1).select(F.lit("status").alias("dimension"), F.explode(F.array(*map(F.lit, COUNTED))).alias("value"), F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("found"))
    return counts.unionByName(none).groupBy("dimension", "value").agg(F.sum("total").alias("total"), F.sum("found").alias("found"))


def coverage_report(cells: DataFrame, concepts: DataFrame | None = None, low_percent: float = 20, pending_share: float = 0.5, most_gaps: int = 10) -> DataFrame:
    """(section, name, n, of, percent): shares of statuses, effective coverage, sources and drawers, concepts with partial evidence only or none, grades of the concepts (concept_id, grade) if these are given, recommendations."""
    summary = coverage_summary(cells)
    share = lambda n, of: F.round(F.when(of > 0, 100 * n / of).otherwise(0.0), 1)
    row = lambda section, name, n, of: [F.lit(section).alias("section"), name.alias("name"), n.alias("n"), of.alias("of"), share(n, of).alias("percent")]
    of_status = lambda *s: F.coalesce(F.sum(F.when((F.col("dimension") == "status") & F.col("value").isin(*s), F.col("total"))), F.lit(0))
    one = summary.agg(F.coalesce(F.sum(F.when(F.col("dimension") == "total", F.col("total"))), F.lit(0)).alias("all"), of_status("PENDING").alias("pending"), of_status("FOUND", "PARTIAL").alias("effective"))
    told = lambda s: F.bool_or(F.col("status") == s)
    evidenced = cells.groupBy("concept_id").agg(told("FOUND").alias("found"), told("PARTIAL").alias("partial"))
    shown = evidenced.agg(F.count(F.lit(1)).alias("concepts"), F.count_if(F.col("partial") & ~F.col("found")).alias("partial_only"), F.count_if(~F.col("partial") & ~F.col("found")).alias("gaps"))
    one = one.unionByName(shown, allowMissingColumns=True).agg(*(F.max(c).alias(c) for c in [*one.columns, *shown.columns]))
    parts = [summary.where("dimension = 'status'").join(one).select(*row("status", F.col("value"), F.col("total"), F.col("all")))]
    parts += [summary.where(F.col("dimension") == d).select(*row(d, F.col("value"), F.col("found"), F.col("total"))) for d in ("source", "drawer")]
    parts += [one.select(*row("coverage", F.lit("effective"), F.col("effective"), F.col("all"))), one.select(*row("evidence", F.lit("partial_only"), F.col("partial_only"), F.col("concepts"))), one.select(*row("evidence", F.lit("none"), F.col("gaps"), F.col("concepts")))]
    if concepts is not None:
        parts.append(grade_counts(concepts).select(*row("grade", F.col("grade"), F.col("n"), F.col("of"))))
    parts.append(summary.where("dimension = 'source'").select(*row("recommendation", F.concat(F.lit("low_coverage:"), "value"), F.col("found"), F.col("total"))).where(F.col("percent") < low_percent))
    parts.append(one.where(F.col("pending") > F.col("all") * pending_share).select(*row("recommendation", F.lit("high_pending_rate"), F.col("pending"), F.col("all"))))
    parts.append(one.where(F.col("gaps") > most_gaps).select(*row("recommendation", F.lit("coverage_gaps"), F.col("gaps"), F.col("concepts"))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def coverage_gaps(coverage: DataFrame) -> DataFrame:
    """Concepts that no source shows even in part."""
    return coverage.groupBy("concept_id").agg(F.every(F.col("status").isin("ABSENT", "PENDING")).alias("gap"), F.count_if(F.col("status") == "FOUND").alias("found")).where("gap").select("concept_id", "found")


def coverage_grid(coverage: DataFrame, sources: list[str]) -> DataFrame:
    """A column for each of the sources given."""
    return coverage.groupBy("concept_id").pivot("source", sources).agg(F.first("status"))


def coverage_lines(coverage: DataFrame) -> DataFrame:
    """(concept_id, cells): all sources of a concept in order, as source=status; any number of sources is one column."""
    pairs = F.array_sort(F.collect_list(F.concat_ws("=", "source", "status")))
    return coverage.groupBy("concept_id").agg(F.array_join(pairs, " ").alias("cells"))
