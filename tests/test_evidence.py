"""Evidence of upgrades, and reasons of verdicts, against plain loops."""

import random

from claimlake.functions import lexicons as L
from claimlake.operators import coverage, rules

RANK = {"PENDING": 0, "ABSENT": 1, "PARTIAL": 2, "FOUND": 3}
CELL = "concept_id string, source string, status string, signature_ids array<string>, documents array<string>, timestamps array<string>"
SEEN = "concept_id string, source string, ord int, status string, document string, timestamp string, signature string"


def matrix_and_sightings(seed):
    rng = random.Random(seed)
    cells = {(f"c{i}", s): (rng.choice([*RANK, "NOT_APPLICABLE"]), ["X"] * rng.randint(0, 2), rng.choice([[], ["d1"]]), []) for i in range(8) for s in "ab"}
    cells = {k: (st, ids, docs, at) if st in ("PARTIAL", "FOUND") else (st, [], [], []) for k, (st, ids, docs, at) in cells.items()}
    seen = [(f"c{rng.randrange(9)}", rng.choice("abz"), i, rng.choice(["FOUND", "PARTIAL", "ABSENT", "ODD"]), rng.choice(["d1", "d2", "d3", "", None]), rng.choice(["1:00", "2:00", "", None]), rng.choice(["IF x", "", None])) for i in range(70)]
    return cells, seen


def test_ranked_upgrades(spark):
    for seed in (1, 2, 3):
        cells, seen = matrix_and_sightings(seed)
        want = {k: list(v) for k, v in cells.items()}
        for concept, source, _, status, document, at, _ in seen:
            cell, new = want.get((concept, source)), status if status in ("FOUND", "PARTIAL") else "ABSENT"
            if cell is None or RANK[new] <= RANK.get(cell[0], 0):
                continue
            if new == "ABSENT":
                cell[:] = [new, [], [], []]
            else:
                cell[:] = [new, [*cell[1], f"PFX-{concept}-{len(cell[1]) + 1}"], sorted({*cell[2], *([document] if document is not None else [])}), [at] if at else []]
        table = spark.createDataFrame([(*k, *v) for k, v in cells.items()], CELL)
        got = coverage.upgrade_ranked_with_evidence(table, spark.createDataFrame(seen, SEEN).repartition(4), "PFX").collect()
        assert {(r.concept_id, r.source): [r.status, r.signature_ids, r.documents, r.timestamps] for r in got} == want


def test_sticky_upgrades(spark):
    for seed in (4, 5):
        cells, seen = matrix_and_sightings(seed)
        want, made = {k: [st, list(ids), list(docs)] for k, (st, ids, docs, _) in cells.items()}, []
        for concept, source, at, status, document, _, signature in seen:
            cell = want.get((concept, source))
            if cell is None:
                continue
            if status == "FOUND" or (status in ("PARTIAL", "ABSENT") and cell[0] == "PENDING"):
                cell[0] = status
            if status == "FOUND":
                if document and document not in cell[2]:
                    cell[2].append(document)
                if signature:
                    cell[1].append(f"TAX-{concept}-{len(cell[1]) + 1}")
                    made.append((concept, source, at, cell[1][-1]))
        table, rows = spark.createDataFrame([(*k, *v) for k, v in cells.items()], CELL), spark.createDataFrame(seen, SEEN).repartition(4)
        got = coverage.upgrade_sticky_with_evidence(table, rows).collect()
        assert {(r.concept_id, r.source): (r.status, r.n_signatures, r.documents) for r in got} == {k: (st, len(ids), docs) for k, (st, ids, docs) in want.items()}
        assert sorted(map(tuple, coverage.sticky_signatures(table, rows, "TAX").collect())) == sorted(made)
    bare = coverage.upgrade_sticky_with_evidence(table.select("concept_id", "source", "status"), rows.limit(0))
    assert {(r.n_signatures, len(r.documents)) for r in bare.collect()} == {(0, 0)}


def test_summary_has_five_statuses_and_names_nulls(spark):
    cells = spark.createDataFrame([("a", "s", None, "NOT_APPLICABLE"), ("b", None, "d", "FOUND")], "concept_id string, source string, drawer string, status string")
    got = {(r.dimension, r.value): (r.total, r.found) for r in coverage.coverage_summary(cells).collect()}
    assert got["status", "NOT_APPLICABLE"] == (1, 0) and got["status", "PENDING"] == (0, 0) and got["total", "all"] == (2, 1)
    assert got["drawer", "unknown"] == (1, 0) and got["source", "unknown"] == (1, 1) and ("drawer", "all") not in got
    grades = spark.createDataFrame([("a", "UNIQUE"), ("b", None), ("c", "UNIQUE")], "concept_id string, grade string")
    report = {(r.section, r.name): (r.n, r.of) for r in coverage.coverage_report(cells, grades).collect()}
    assert report["grade", "UNIQUE"] == (2, 3) and report["grade", "UNKNOWN"] == (1, 3)


def test_reasons_and_citations(spark):
    rows = [
        ("1", "price up", "go", None, None), ("2", "price up", "go", None, "s"), ("3", "it will Always hold", "go", "1", "s"), ("4", "price", "buy and sell", "1", "s"), ("5", "price", " ", "1", "s"),
        ("6", "Price rises now", "price moves up", "1", "s"), ("7", "a b c d", "a b c e", "1", "s"), ("8", "it looks", "go", "1", "s"), ("9", "up", "it Feels", "1", "s"), ("10", "bullish trend seen today", "act", "1", "s"), ("11", "fine", "go", "1", "s"),
    ]
    signatures = spark.createDataFrame(rows, "id string, condition string, action string, source_timestamp string, source string")
    theory = spark.createDataFrame([(1, " Bearish trend SEEN today " + "x" * 90), (2, "bearish")], "line_no int, line string")
    verdicts = rules.audit(signatures, theory=theory)
    got = {r.id: (r.reason, r.citation) for r in verdicts.collect()}
    text = {code: (reason, citation) for code, reason, citation in L.REASONS}
    assert got["1"] == text["provenance:source"] and got["2"] == text["provenance:timestamp"] and got["4"] == text["logical_consistency:contradiction"] and got["5"] == text["logical_consistency:empty"]
    assert got["3"] == ("Unfalsifiable claim — contains absolute marker: 'always'", text["falsifiability"][1])
    assert got["6"] == ("Tautology — condition 'price rises' restates action 'price moves up'", text["tautology:pair"][1])
    assert got["7"] == ("Tautology suspected — 3 words overlap between condition and action", text["tautology:overlap"][1])
    assert got["8"][0] == "Ambiguity — condition contains subjective marker: 'looks'" and got["9"] == ("Ambiguity — action contains subjective marker: 'feels'", text["ambiguity:action"][1])
    assert got["10"] == ("Conflicts with canon — condition uses 'bullish' but the theory contains 'bearish' in similar context", f"Theory line containing: '{('bearish trend seen today ' + 'x' * 90)[:80]}'")
    assert got["11"] == (None, None)
    validated, rejected = rules.split_verdicts(verdicts)
    assert {r.id for r in validated.collect()} == {"11"} and rejected.count() == 10
