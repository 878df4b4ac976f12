"""Audit rules over signatures (condition, action, source, source_timestamp)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import first_of


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def _words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[ \t\n\x0B\f\r]+"), lambda w: w != ""))


def _any(columns: list[str], *names: str) -> Column:
    """Whether one of the columns that there are isn't blank."""
    out = F.lit(False)
    for name in names:
        out = out | ~_blank(name) if name in columns else out
    return out


def provenance(columns: list[str]) -> Column:
    """A time is needed; either name of time and source will do."""
    timed, sourced = _any(columns, "source_timestamp", "timestamp"), _any(columns, "source", "source_url")
    return F.when(~timed & ~sourced, "provenance:source").when(~timed, "provenance:timestamp")


def falsifiability(markers: tuple[str, ...]) -> Column:
    found = F.get(F.filter(F.array(*map(F.lit, markers)), lambda m: F.contains(F.lower("condition"), m) | F.contains(F.lower("action"), m)), 0)
    return F.when(found.isNotNull(), F.concat(F.lit("falsifiability:"), found))


def consistency() -> Column:
    action = F.lower("action")
    clash = F.contains(action, F.lit("buy")) & F.contains(action, F.lit("sell")) & ~F.contains(action, F.lit("or"))
    return F.when(clash, "logical_consistency:contradiction").when((F.trim("condition") == "") | (F.trim("action") == ""), "logical_consistency:empty")


def tautology(pairs: tuple[tuple[str, str], ...], threshold: float) -> Column:
    condition, action = F.lower("condition"), F.lower("action")
    direct = F.lit(False)
    for left, right in pairs:
        direct = direct | (F.contains(condition, F.lit(left)) & F.contains(action, F.lit(right)))
    a, b = _words(F.col("condition")), _words(F.col("action"))
    smaller = F.least(F.size(a), F.size(b))
    same = (smaller >= 3) & (F.size(F.array_intersect(a, b)) > threshold * smaller)
    return F.when(direct, "tautology:pair").when(same, "tautology:overlap")


def ambiguity(markers: tuple[str, ...]) -> Column:
    """The first marker, and the field that has it, the condition before the action."""
    found = F.get(F.filter(F.array(*map(F.lit, markers)), lambda m: F.contains(F.lower("condition"), m) | F.contains(F.lower("action"), m)), 0)
    field = F.when(F.contains(F.lower("condition"), found), "condition").otherwise("action")
    return F.when(found.isNotNull(), F.concat_ws(":", F.lit("ambiguity"), found, field))


def explain(failed: Column, pairs: tuple[tuple[str, str], ...], canon_terms: Column | None = None, canon_line: Column | None = None) -> Column:
    """(reason, citation) of a failed check, null for none."""
    marker = F.regexp_extract(failed, "^[^:]*:(.*?)(?::(?:condition|action))?$", 1)
    known = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs)) if pairs else F.array().cast("array<struct<a:string,b:string>>")
    pair = F.get(F.filter(known, lambda p: F.contains(F.lower("condition"), p["a"]) & F.contains(F.lower("action"), p["b"])), 0)
    shared = F.size(F.array_intersect(_words(F.col("condition")), _words(F.col("action"))))
    none = F.lit(None).cast("string")
    terms = (canon_terms["a"], canon_terms["b"]) if canon_terms is not None else (none, none)
    fillers = {"falsifiability": [marker], "tautology:pair": [pair["a"], pair["b"]], "tautology:overlap": [shared.cast("string")], "ambiguity:condition": [marker], "ambiguity:action": [marker], "canon_conflict": [*terms]}
    out = F.when(failed.isNull(), None)
    for code, reason, citation in L.REASONS:
        check, _, field = code.partition(":")
        hit = F.startswith(failed, F.lit(check + ":")) & (F.endswith(failed, F.lit(":" + field)) if field else F.lit(True))
        filled = F.format_string(reason, *fillers[code]) if code in fillers else F.lit(reason)
        cited = F.format_string(citation, F.substring(F.btrim(F.lower(canon_line)), 1, 80)) if code == "canon_conflict" and canon_line is not None else F.lit(citation)
        out = out.when(hit, F.struct(filled.alias("reason"), cited.alias("citation")))
    return out


def audit(signatures: DataFrame, absolute=L.ABSOLUTE_MARKERS, ambiguous=L.AMBIGUOUS_MARKERS, pairs=L.TAUTOLOGIES, overlap: float = 0.7, theory: DataFrame | None = None, contradictions=L.CONTRADICTIONS) -> DataFrame:
    """Adds check_failed (the first rule that fails, with its marker), verdict, attempts, and the reason and citation of a rejection.

    theory holds lines (line_no, line) of canon, which the last rule holds signatures (with an id) against.
    """
    checks = [provenance(signatures.columns), falsifiability(absolute), consistency(), tautology(pairs, overlap), ambiguity(ambiguous)]
    terms = line = None
    if theory is not None:
        from .joins import canon_conflict, lookup

        against = canon_conflict(signatures, theory, contradictions).join(lookup(theory.select("line_no", F.col("line").alias("__line"))), "line_no").select("id", F.col("pair_no").alias("__pair"), "__line")
        signatures = signatures.join(against, "id", "left")
        terms, line = F.get(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in contradictions)), F.col("__pair")), F.col("__line")
        checks.append(F.when(F.col("__pair").isNotNull(), F.concat(F.lit("canon_conflict:"), terms["a"])))
    at = F.coalesce(*(F.when(c.isNotNull(), i + 1) for i, c in enumerate(checks)))
    out = signatures.withColumns({"check_failed": F.coalesce(*checks), "attempts": F.least(F.coalesce(at, F.lit(3)), F.lit(3))})
    out = out.withColumns({"verdict": F.when(F.col("check_failed").isNull(), "NO_FALSIFICATION_FOUND").otherwise("REJECT"), "__told": explain(F.col("check_failed"), pairs, terms, line)})
    return out.withColumns({"reason": F.col("__told.reason"), "citation": F.col("__told.citation")}).drop("__pair", "__line", "__told")


def split_verdicts(verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(validated, rejected) of audited signatures, which are worked out once: written to the shared folder, then filtered twice."""
    from ..sources.shared import materialise

    told = materialise(verdicts, "verdicts")
    return told.where("verdict <> 'REJECT'"), told.where("verdict = 'REJECT'")


def audit_summary(verdicts: DataFrame, by: list[str]) -> DataFrame:
    """Totals, rejection rate in percent and its status for each group."""
    rejected = F.count_if(F.col("verdict") == "REJECT")
    out = verdicts.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), rejected.alias("rejected"))
    rate = F.col("rejected") / F.col("total")
    status = F.when(F.col("total") < 5, "OK").when(F.col("rejected") == 0, "RUBBER_STAMP").when(rate < 0.05, "CRITICAL_LOW").when(rate < 0.10, "BELOW_TARGET").otherwise("OK")
    return out.withColumns({"passed": F.col("total") - F.col("rejected"), "rejection_pct": F.round(100 * rate, 1), "rate_status": status})


def rejection_reasons(verdicts: DataFrame, by: list[str]) -> DataFrame:
    return verdicts.where("verdict = 'REJECT'").groupBy(*by, F.split("check_failed", ":")[0].alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def narrative_violations(c: Column, phrases=L.NARRATIVE, exclude_quotes: bool = False) -> Column:
    """Phrases that a text contains in either case; lines of tables may be left out first."""
    if exclude_quotes:
        c = F.array_join(F.filter(F.transform(F.split(c, "\n"), lambda line: F.trim(line)), lambda line: ~(line.startswith("|") & ~line.startswith("|-"))), "\n")
    return F.filter(F.array(*map(F.lit, phrases)), lambda p: F.contains(F.lower(c), F.lower(p)))


def confidence(c: Column, markers=L.INFERRED_MARKERS) -> Column:
    return F.when(first_of(F.lower(c), markers).isNotNull(), "INFERRED").otherwise("EXPLICIT")
