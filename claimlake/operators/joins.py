"""Lexicon, lookup and upsert joins. Small tables are broadcast after a check of their size, larger ones shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .matching import best_kinds, first_overlaps, found_in

#: Rows that a broadcast table may have.
MOST_LEXICON_ROWS = 100_000
#: Needles that are looked for in place in each text; larger lexicons become automata.
MOST_NEEDLES = 24


def lookup(table: DataFrame, most: int = MOST_LEXICON_ROWS) -> DataFrame:
    """The table to join with: broadcast if it has few rows, else as it is, for a join by shuffle."""
    return table if table.limit(most + 1).count() > most else F.broadcast(table)


def _forms(text_col: str, preprocessed: bool) -> dict[str, Column]:
    """The lower-case forms of a text in which patterns are looked for."""
    return {"raw": F.lower(text_col)} | ({"clean": F.lower(T.preprocess(F.col(text_col)))} if preprocessed else {})


def pattern_match(docs: DataFrame, vectors: DataFrame, id_col: str, text_col: str, distinct: bool = True, preprocessed: bool = True) -> DataFrame:
    """(id, pattern_id): lower-case patterns contained in the raw or, if wanted, the preprocessed text; distinct needs state on a stream."""
    forms = _forms(text_col, preprocessed)
    rows = docs.select(id_col, *(c.alias(n) for n, c in forms.items()))
    found = found_in(rows, [*forms], vectors.select(F.col("id").alias("name"), F.lower("pattern").alias("needle")), most_in_place=MOST_NEEDLES)
    found = found.select(id_col, F.explode(F.array_distinct("names")).alias("pattern_id"))
    return found.distinct() if distinct else found


def screen(docs: DataFrame, vectors: DataFrame, id_col: str, text_col: str, mode: str = "halt", semantic: DataFrame | None = None, block_above: float = 0.92, keep: list[str] | None = None, preprocessed: bool = True) -> DataFrame:
    """Every document with its matches in the raw or, if wanted, the preprocessed text, whether it is clean, and whether it is blocked in the mode given.

    semantic holds (id, pattern_id, similarity) of reports.semantic_match; each is a flag. In mode "halt" any match or flag
    blocks, in any other mode only a similarity above the bound. Columns in `keep` go along.
    """
    zero = F.lit(0).cast("long")
    kept = keep or []
    forms = _forms(text_col, preprocessed)
    rows = docs.select(id_col, *kept, T.unicode_abuse(F.col(text_col)).alias("warned"), *(c.alias(n) for n, c in forms.items()))
    found = found_in(rows, [*forms], vectors.select(F.col("id").alias("name"), F.lower("pattern").alias("needle")), most_in_place=MOST_NEEDLES)
    names = F.array_distinct("names")  # no row leaves its partition
    out = found.select(id_col, *kept, "warned", F.size(names).cast("long").alias("matches"), F.array_min(names).alias("first_pattern"))
    if semantic is None:
        out = out.withColumns({"flags": zero, "top": F.lit(None).cast("double")})
    else:
        flagged = semantic.groupBy(id_col).agg(F.count(F.lit(1)).alias("flags"), F.max("similarity").alias("top"))
        out = out.join(flagged, id_col, "left").withColumn("flags", F.coalesce("flags", zero))
    clean = (F.col("matches") == 0) & (F.col("flags") == 0)
    blocked = ~clean if mode == "halt" else F.coalesce(F.col("top") > block_above, F.lit(False))
    reason = F.concat_ws("; ", F.when(F.col("matches") > 0, F.format_string("pattern_match(%d)", "matches")), F.when(F.col("flags") > 0, F.format_string("semantic_flag(%d)", "flags")))
    out = out.withColumns({"clean": clean, "blocked": blocked, "reason": F.nullif(reason, F.lit(""))}).drop("top")
    return out.drop("flags") if semantic is None else out


def canon_conflict(signatures: DataFrame, theory: DataFrame, pairs: tuple[tuple[str, str], ...], least: int = 3) -> DataFrame:
    """(id, line_no, pair_no): of each signature (id, condition) that conflicts, the first pair and theory line (line_no, line) with the opposite term and enough shared words."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")).alias("words")
    having = lambda c, term: F.filter(F.array(*(F.when(F.contains(F.lower(c), F.lit(p[term])), i) for i, p in enumerate(pairs))), lambda x: x.isNotNull())
    own = signatures.select("id", having("condition", 0).alias("groups"), words("condition")).where(F.size("groups") > 0)
    lines = theory.select("line_no", F.explode(having("line", 1)).alias("group_no"), words("line"))
    return first_overlaps(own, lines, least).select("id", F.col("line_no").cast(theory.schema["line_no"].dataType).alias("line_no"), F.col("group_no").alias("pair_no"))


def exclude_negatives(signatures: DataFrame, negatives: DataFrame) -> DataFrame:
    """Signatures without those whose condition or action contains a negative's reason; empty reasons count for nothing."""
    reasons = negatives.select(F.lower("reason").alias("needle")).where("needle <> ''").distinct().select(F.lit(0).alias("name"), "needle")
    low = signatures.withColumns({"__condition": F.lower("condition"), "__action": F.lower("action")})
    return found_in(low, ["__condition", "__action"], reasons, "__found", MOST_NEEDLES).where(F.size("__found") == 0).select(signatures.columns)


def _alike(drawers: DataFrame, names: DataFrame) -> DataFrame:
    """(drawer, drawer_name): distinct drawers and names one of which contains the other."""
    both = ["drawer", "drawer_name"]
    within = found_in(drawers, ["drawer"], names.select(F.col("drawer_name").alias("name"), F.col("drawer_name").alias("needle"))).select("drawer", F.explode("names").alias("drawer_name"))
    around = found_in(names, ["drawer_name"], drawers.select(F.col("drawer").alias("name"), F.col("drawer").alias("needle"))).select(F.explode("names").alias("drawer"), "drawer_name")
    return within.unionByName(around.select(both)).distinct()


def match_concepts(claims: DataFrame, concepts: DataFrame, top: int = 3, least: int = 2, most: int | None = None) -> DataFrame:
    """(claim_id, concept_id, score, rank) of claims (claim_id, text, drawer, concept_id) and concepts (concept_id, ord, terms, drawer_name).

    A claim that names a known concept matches it alone, with a null score. Otherwise a concept gets a point for each term that the text
    contains, and two if the drawers of claim and concept contain one another, in either case; the first of equals by ord rank.
    Concepts with the same terms and drawer always score alike, so they are met as one kind, of which the first `top` can rank; kinds are scored where the text was read, and a claim leaves its task with its best alone.
    Any number of concepts, terms and drawers may be given; up to `most` terms are looked for in place. Claims without a column drawer or concept_id have none.
    """
    claims = claims.withColumns({c: F.lit(None).cast(concepts.schema[of].dataType) for c, of in (("drawer", "drawer_name"), ("concept_id", "concept_id")) if c not in claims.columns})
    named = claims.select("claim_id", "concept_id").join(concepts.select("concept_id").distinct(), "concept_id").select("claim_id", "concept_id", F.lit(None).cast("long").alias("score"), F.lit(1).alias("rank"))
    low = concepts.select("concept_id", "ord", F.array_sort(F.transform("terms", lambda x: F.lower(x))).alias("terms"), F.coalesce(F.upper("drawer_name"), F.lit("")).alias("drawer_name"))
    within = F.row_number().over(Window.partitionBy("terms", "drawer_name").orderBy("ord", "concept_id"))
    leading = low.withColumn("n", within).where(F.col("n") <= top)
    kinds = leading.groupBy("terms", "drawer_name").agg(F.array_sort(F.collect_list(F.struct("ord", "concept_id"))).alias("members"))
    # each distinct term is looked for once in a text, however many concepts have it
    distinct = kinds.select(F.explode("terms").alias("term")).distinct()
    rows = claims.select("claim_id", F.upper("drawer").alias("drawer"), F.lower("text").alias("low"))
    hits = found_in(rows, ["low"], distinct.select(F.col("term").alias("name"), F.col("term").alias("needle")), "terms", MOST_NEEDLES if most is None else most).select("claim_id", "drawer", "terms")
    # drawers meet as distinct names
    alike = _alike(claims.select(F.upper("drawer").alias("drawer")).where("drawer <> ''").distinct(), kinds.select("drawer_name").where("drawer_name <> ''").distinct())
    own = hits.join(lookup(alike.groupBy("drawer").agg(F.collect_list("drawer_name").alias("alike"))), "drawer", "left").select("claim_id", "terms", "alike")
    own = own.join(named.select("claim_id"), "claim_id", "left_anti").where((F.size("terms") > 0) | F.col("alike").isNotNull())
    by = Window.partitionBy("claim_id").orderBy(F.desc("score"), "ord")
    ranked = best_kinds(own, kinds, top, least).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return ranked.select("claim_id", "concept_id", "score", "rank").unionByName(named)


def find_claims(specs: DataFrame, claims: DataFrame) -> DataFrame:
    """Each spec with the claim of its bundle, else of the newest bundle that has the signature; misses stay, with nulls.

    A spec meets one row: its bundle's, or the newest of its signature, found beforehand.
    """
    own = claims.groupBy(F.col("bundle").alias("of"), F.col("signature").alias("own")).agg(F.min("claim").alias("own_claim"))
    newest = own.groupBy(F.col("own").alias("any")).agg(F.max("of").alias("newest"), F.max_by("own_claim", "of").alias("newest_claim"))
    met = specs.join(own, (F.col("signature") == F.col("own")) & (F.col("bundle") == F.col("of")), "left").join(newest, F.col("signature") == F.col("any"), "left")
    bare = F.col("bundle").isNull()
    return met.select("spec_id", "signature", F.when(bare, F.col("newest")).otherwise(F.col("of")).alias("found_bundle"), F.when(bare, F.col("newest_claim")).otherwise(F.col("own_claim")).alias("claim"))


def update_status(queue: DataFrame, updates: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """Queue rows with the status, bundle and error of their update, if there is one; of several the first in `order`, or the smallest."""
    value = F.struct("status", "bundle_id", "error")
    u = updates.groupBy(key).agg((F.min_by(value, F.struct(order, value)) if order else F.min(value)).alias("u"))
    out = queue.join(u, key, "left")
    kept = [c for c in queue.columns if c not in ("status", "bundle_id", "error")]
    return out.select(*kept, *(F.coalesce(F.col(f"u.{c}"), F.col(c)).alias(c) for c in ("status", "bundle_id", "error")))


def route_models(calls: DataFrame, routes: DataFrame) -> DataFrame:
    """The model of (tier, role), else of the role in tier 'default'."""
    exact = lookup(routes.select(F.col("tier"), F.col("role"), F.col("model").alias("exact")))
    default = lookup(routes.where("tier = 'default'").select("role", F.col("model").alias("fallback")))
    return calls.join(exact, ["tier", "role"], "left").join(default, "role", "left").withColumn("model", F.coalesce("exact", "fallback")).drop("exact", "fallback")


def call_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Adds cost_usd; calls of models without a price have no row."""
    tokens = lambda c: F.coalesce(F.col(c), F.lit(0)) / 1e6
    return usage.join(lookup(prices), "model").withColumn("cost_usd", tokens("prompt_tokens") * F.col("input_per_m") + tokens("completion_tokens") * F.col("output_per_m")).drop("input_per_m", "output_per_m")
