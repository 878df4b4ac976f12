"""Rules on small rows, each with the case that tells it from a simpler one."""

from pyspark.sql import functions as F

from claimlake.functions import text as T
from claimlake.operators import chunking, corpus, coverage, joins, prompts, reports, rules
from claimlake.operators.ordinal import running_total
from claimlake.streaming import logs


def test_sticky_status_replaces_pending(spark):
    rows = [("a", "PENDING", 1), ("a", "ABSENT", 2), ("a", "PARTIAL", 3), ("b", "PENDING", 1), ("c", "ABSENT", 1), ("c", "FOUND", 2), ("d", "PARTIAL", 1), ("d", "ABSENT", 2)]
    got = coverage.upgrade_sticky(spark.createDataFrame([(c, "s", st, o) for c, st, o in rows], "concept_id string, source string, status string, ord int"))
    assert {r.concept_id: r.status for r in got.collect()} == {"a": "ABSENT", "b": "PENDING", "c": "FOUND", "d": "PARTIAL"}


def test_daily_cost_is_over_all_sessions(spark):
    rows = [(1, "2024-01-01 01:00:00", 1, 0.6), (2, "2024-01-01 02:00:00", 2, 0.6), (3, "2024-01-02 00:00:00", 1, 0.1), (4, "2024-01-02 00:00:01", 3, None)]
    log = spark.createDataFrame(rows, "event_id int, ts string, session int, cost double").withColumn("ts", F.to_timestamp("ts"))
    got = {r.event_id: r for r in corpus.cost_guard(log, 5.0, 1.0).collect()}
    assert [got[i].daily_total for i in (1, 2, 3, 4)] == [0.6, 1.2, 0.1, 0.1]
    assert [got[i].halted for i in (1, 2, 3, 4)] == [False, True, False, False]
    assert not any(r.halted for r in corpus.cost_guard(log, 5.0, 1.0, halt=False).collect())
    status = {r.session: (r.within_cost, r.allowed) for r in corpus.guard_status(log, 20, None, (5.0, 1.0)).collect()}
    assert status == {1: (True, True), 2: (False, False), 3: (True, True)}
    assert all(r.allowed for r in corpus.guard_status(log, None, None, None).collect())


def test_running_total_of_one_large_group(spark):
    rows = spark.range(5000).select(F.lit(None).cast("int").alias("g"), F.col("id"))
    got = {r.id: r.total for r in running_total(rows, "g", ["id"], F.col("id"), "total").collect()}
    assert all(got[i] == i * (i + 1) // 2 for i in range(5000))


def test_concepts_by_name_drawer_and_terms(spark):
    concepts = spark.createDataFrame([("x", 1, ["gap", "fair value"], "drawer_2"), ("y", 2, ["order block"], "Drawer_3"), ("z", 3, ["gap"], None)], "concept_id string, ord int, terms array<string>, drawer_name string")
    claims = [(1, "a Gap of fair value", None, None), (2, "order block", "3", None), (3, "nothing", "DRAWER_2", None), (4, "gap", "9", None), (5, "gap", None, "y"), (6, "gap, fair value", None, "unknown")]
    got = joins.match_concepts(spark.createDataFrame(claims, "claim_id int, text string, drawer string, concept_id string"), concepts)
    assert {(r.claim_id, r.concept_id, r.score, r["rank"]) for r in got.collect()} == {(1, "x", 2, 1), (2, "y", 3, 1), (3, "x", 2, 1), (5, "y", None, 1), (6, "x", 2, 1)}


def test_lexicons_of_any_size(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "three"), (4, "<b>t</b>wo")], "doc_id int, text string")
    vectors = spark.createDataFrame([("a", "ONE"), ("b", "two"), ("c", "four")], "id string, pattern string")
    signatures = docs.select("doc_id", F.col("text").alias("condition"), F.lit("act").alias("action"))
    negatives = vectors.select(F.col("pattern").alias("reason"))

    def found():
        clean = {r.doc_id: (r.matches, r.first_pattern) for r in joins.screen(docs, vectors, "doc_id", "text").collect()}
        return {tuple(r) for r in joins.pattern_match(docs, vectors, "doc_id", "text").collect()}, clean, {r.doc_id for r in joins.exclude_negatives(signatures, negatives).collect()}

    want = ({(1, "a"), (1, "b"), (4, "b")}, {1: (2, "a"), 2: (0, None), 3: (0, None), 4: (1, "b")}, {2, 3, 4})
    assert found() == want
    monkeypatch.setattr(joins, "MOST_NEEDLES", 1)
    monkeypatch.setattr(joins, "MOST_LEXICON_ROWS", 2)
    assert found() == want


def test_audit_by_all_rules(spark):
    rows = [
        ("1", "price up", "go", None, None, None, None), ("2", "price up", "go", None, "", "u", None), ("3", "price up", "go", None, "0:01", None, None), ("4", "long wait for it", "go", "1", None, None, None),
        ("5", "price rises now", "price moves up", "1", None, None, "s"), ("6", "it looks", "go", "1", None, None, None), ("7", "up", "it Feels", "1", None, None, None), ("8", "bullish trend seen today", "act", "1", None, None, None),
    ]
    signatures = spark.createDataFrame(rows, "id string, condition string, action string, source_timestamp string, timestamp string, source_url string, source string")
    theory = spark.createDataFrame([(1, "Bearish trend"), (2, "short wait for a while"), (3, "bearish trend SEEN today")], "line_no int, line string")
    got = {r.id: (r.check_failed, r.attempts) for r in rules.audit(signatures, theory=theory).collect()}
    assert got == {"1": ("provenance:source", 1), "2": ("provenance:timestamp", 1), "3": (None, 3), "4": (None, 3), "5": ("tautology:pair", 3), "6": ("ambiguity:looks:condition", 3), "7": ("ambiguity:feels:action", 3), "8": ("canon_conflict:bullish", 3)}
    assert [tuple(r) for r in joins.canon_conflict(signatures, theory, (("bullish", "bearish"), ("long", "short"))).collect()] == [("8", 3, 0)]


def test_narrative_lines(spark):
    rows = spark.createDataFrame([("  | I think |\nlikely",), ("|- I think",)], "t string").select(rules.narrative_violations(F.col("t"), exclude_quotes=True).alias("v"))
    assert [r.v for r in rows.collect()] == [["likely"], ["I think"]]


def test_first_update_wins(spark):
    queue = spark.createDataFrame([(1, "QUEUED", None, None)], "id int, status string, bundle_id string, error string")
    updates = spark.createDataFrame([(1, "DONE", "b", None, 2), (1, "FAILED", None, "e", 1)], "id int, status string, bundle_id string, error string, ord int")
    assert joins.update_status(queue, updates, order="ord").first().status == "FAILED" and joins.update_status(queue, updates).first().status == "DONE"


def test_find_claims(spark):
    claims = spark.createDataFrame([("b1", "s", 1), ("b2", "s", 2), ("b1", "t", 3)], "bundle string, signature string, claim int")
    specs = spark.createDataFrame([(1, "b1", "s"), (2, None, "s"), (3, "b2", "t"), (4, None, "none")], "spec_id int, bundle string, signature string")
    assert {(r.spec_id, r.found_bundle, r.claim) for r in joins.find_claims(specs, claims).collect()} == {(1, "b1", 1), (2, "b2", 2), (3, None, None), (4, None, None)}


def test_small_text_functions(spark):
    rows = spark.createDataFrame([("https://x/watch?list=PL_a-1&x=2", "B-1:S-2:x", "FOUND"), ("none", "S-9", None)], "u string, s string, c string")
    got = rows.select(T.playlist_id(F.col("u")).alias("p"), T.claim_spec(F.col("s")).alias("s"), T.status_symbol(F.col("c")).alias("a"), T.status_word(F.col("c")).alias("b")).collect()
    assert [(r.p, tuple(r.s), r.a, r.b) for r in got] == [("PL_a-1", ("B-1", "S-2:x"), "Y", "FOUND"), (None, (None, "S-9"), ".", "?")]
    odd = spark.createDataFrame([("a͸" * 3,), ("a" * 99 + "​",), ("",)], "t string").select(T.unicode_abuse(F.col("t")).alias("x"))
    assert [r.x for r in odd.collect()] == [True, False, False]
    ids = rows.select(prompts.bundle_id(F.lit("2024-01-02 03:04:05").cast("timestamp"), F.col("u")).alias("i")).collect()
    assert all(r.i.startswith("B-20240102-030405-") for r in ids) and ids[0].i != ids[1].i


def test_chunk_prompts(spark):
    chunks = spark.createDataFrame([(1, 2, "b", "page 2", "CANON", "f"), (1, 1, "a", "page 1", "CANON", "f")], "doc_id int, chunk_num int, text string, provenance string, source_tier string, source_file string")
    assert prompts.format_chunks(chunks).first().prompt == "[page 1] [CANON] f\na\n\n[page 2] [CANON] f\nb\n\n"


def test_bundles_keep_cells_in_lines(spark):
    rows = spark.createDataFrame([(1, "S-001", "IF a\n b | c", "THEN d")], "doc_id int, id string, condition string, action string")
    parsed = reports.parse_bundles(reports.render_bundles(rows, "doc_id", "id"), "doc_id").first()
    assert (parsed.id, parsed.condition, parsed.action) == ("S-001", "IF a b | c", "THEN d")


def test_yields_and_runs(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id int, source string")
    signatures = spark.createDataFrame([(1, "REJECT"), (1, "OK")], "id int, verdict string")
    assert {tuple(r) for r in reports.yield_summary(docs, signatures, "source").collect()} == {("a", 2, 1, 1, 2, 1, 1), (None, 1, 0, 1, 0, 0, 0)}
    results = spark.createDataFrame([(1, "DONE"), (2, "FAILED"), (3, "DONE")], "id int, status string")
    assert tuple(reports.run_summary(results, docs.where("id < 0")).first()) == (0, 2, 1, 0)


def test_gates(spark):
    rows = spark.createDataFrame([(20, 4, 0.01), (5, 1, 0.2), (0, 0, 0.0)], "total int, rejected int, error_rate double")
    got = [(r.signatures, r.rejection, r.jargon, r.all_pass) for r in corpus.gates(rows).collect()]
    assert got == [("PASS", "PASS", "PASS", True), ("FAIL (5)", "PASS", "FAIL (20.0%)", False), ("FAIL (0)", "FAIL (0%)", "PASS", False)]


def test_report_of_coverage(spark):
    cells = spark.createDataFrame([("a", "s", "1", "FOUND"), ("a", "t", "1", "PENDING"), ("b", "s", "2", "PARTIAL"), ("b", "t", "2", "PENDING"), ("c", "s", "2", "PENDING")], "concept_id string, source string, drawer string, status string")
    got = {(r.section, r.name): (r.n, r.of, r.percent) for r in coverage.coverage_report(cells, most_gaps=0).collect()}
    assert got[("status", "ABSENT")] == (0, 5, 0.0) and got[("coverage", "effective")] == (2, 5, 40.0) and got[("source", "s")] == (1, 3, 33.3)
    assert got[("evidence", "partial_only")] == (1, 3, 33.3) and got[("evidence", "none")] == (1, 3, 33.3)
    assert {n for s, n in got if s == "recommendation"} == {"low_coverage:t", "high_pending_rate", "coverage_gaps"}
    assert coverage.coverage_report(cells.where("source = 'none'")).where("n > 0").count() == 0


def test_evidence_grows_in_order(spark):
    cells = spark.createDataFrame([("a", "s", "PENDING", ["x"], None, None), ("b", "s", "ABSENT", None, None, None)], "concept_id string, source string, status string, signature_ids array<string>, bundles array<string>, documents array<string>")
    matches = spark.createDataFrame([("a", "s", 2, "y", "b1", ""), ("a", "s", 1, "z", "b1", None), ("a", "s", 3, "x", "b0", "d"), ("a", "t", 1, "q", "b", "d"), ("n", "s", 1, "q", "b", "d")], "concept_id string, source string, ord int, signature_id string, bundle string, document string")
    got = {r.concept_id: (r.status, r.signature_ids, r.bundles, r.documents) for r in coverage.from_claims(cells, matches).collect()}
    assert got == {"a": ("FOUND", ["x", "z", "y"], ["b1", "b0"], ["d"]), "b": ("ABSENT", [], [], [])}


def test_screened_and_audited_streams(spark, tmp_path):
    spark.createDataFrame([(1, "ONE two"), (2, "nil")], "doc_id int, text string").write.parquet(str(tmp_path / "docs"))
    vectors = spark.createDataFrame([("a", "one"), ("b", "two")], "id string, pattern string")
    stream = spark.readStream.schema("doc_id int, text string").parquet(str(tmp_path / "docs"))
    logs.screened(stream, vectors, "doc_id", "text").writeStream.format("memory").queryName("screened").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert {tuple(r) for r in spark.table("screened").collect()} == {(1, "a"), (1, "b")}
    spark.createDataFrame([("up", "it looks", "1")], "condition string, action string, source_timestamp string").write.parquet(str(tmp_path / "sigs"))
    stream = spark.readStream.schema("condition string, action string, source_timestamp string").parquet(str(tmp_path / "sigs"))
    logs.audited(stream).writeStream.format("memory").queryName("audited").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("audited").first().check_failed == "ambiguity:looks:action"


def test_chunk_modes_and_labels(spark):
    docs = spark.createDataFrame([(1, "# A\nfirst\n# B\nsecond"), (2, "")], "doc_id int, text string")
    by_section, by_size = chunking.chunk(docs, "sections"), chunking.chunk(docs, "size", 12, 2)
    assert by_section.select(chunking.provenance_label(by_section).alias("p")).first().p == "section: A"
    assert by_size.orderBy("chunk_num").select(chunking.provenance_label(by_size).alias("p")).first().p.startswith("chars 0-")
    pages = chunking.chunk(docs.withColumn("page_num", F.lit(1)), "pages")
    assert pages.select(chunking.provenance_label(pages).alias("p")).first().p == "page 1"
    assert by_size.drop("start").select(chunking.provenance_label(by_size.drop("start")).alias("p")).orderBy("p").first().p.startswith("chunk ")


def test_concept_prompts(spark):
    concepts = spark.createDataFrame([("c2", 2, "d1", "Two", None, ["t"]), ("c1", 1, "d1", "One", "x" * 300, list("abcdefg"))], "concept_id string, ord int, drawer string, name string, definition string, terms array<string>")
    got = prompts.concept_prompts(spark.createDataFrame([(1, "body")], "doc_id int, text string"), concepts, "Answer.", 3).first()
    assert got.prompt == "CONCEPTS:\n- c1: One - " + "x" * 200 + " (terms: a, b, c, d, e)\n- c2: Two -  (terms: t)\n\nCONTENT:\nbod\n\nAnswer."


def test_evidence_text(spark):
    kinds = "bundle_id string, source string, span string, signatures array<struct<id:string,condition:string,action:string,at:string>>, deltas array<struct<parameter:string,current:string,value:string,change:string>>, gates array<struct<name:string,status:string,notes:string>>, results array<struct<id:string,verdict:string,reason:string>>, auditor string, negatives array<string>"
    rows = [("B-1", "u", "0:00-1:00", [("S-1", "IF a", "THEN I think", "0:01")], [("p", "1", "2", "NEW"), ("q", "1", "2", "CHANGED")], [("risk", "PASS", "ok")], [("S-1", "NO", None), ("S-2", "REJECT", "vague")], "m", ["N-1", "N-2"]), ("B-2", "u", "0:00", [], None, None, [], None, None)]
    told = reports.render_evidence(spark.createDataFrame(rows, kinds), ("I think",))
    one, two = told.orderBy("bundle_id").collect()
    assert "| S-1 | IF a | THEN I think | 0:01 |" in one.text and "| RISK | PASS | ok |" in one.text and "- S-2: vague" in one.text and one.novel == 1 and one.bleed == []
    assert "No validated signatures" in two.text and "| TEMPORAL | PENDING |  |" in two.text and "- None" in two.text and two.novel == 0
    assert {tuple(r) for r in reports.parse_evidence(told).collect()} == {("B-1", 1, 1, "m", "N-1, N-2"), ("B-2", 0, 0, "pending", "none")}
