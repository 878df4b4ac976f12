"""Archives, files with bad lines, observed writes, responders, and reports on small rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from claimlake.operators import prompts, reports
from claimlake.sources import records, shared, sinks


def events(spark, rows):
    schema = "id string, type string, content string, timestamp string"
    return spark.createDataFrame([(i, "T", "x", f"{day}T00:00:0{n % 10}") for n, (i, day) in enumerate(rows)], schema)


def held(df):
    return sorted((r.id, str(r.session_date), r.part) for r in df.collect())


def test_archive_loses_no_day_between_its_steps(spark, tmp_path, monkeypatch):
    live, archived = str(tmp_path / "live"), str(tmp_path / "archived")
    sinks.append_events(events(spark, [("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-05"), ("d", "2024-01-09"), ("e", "oddly-long")]), live)
    want = [("a", "2024-01-01", "archived"), ("b", "2024-01-01", "archived"), ("c", "2024-01-05", "live"), ("d", "2024-01-09", "live"), ("e", "oddly-long", "live")]

    def fails(spark, path):
        if "archive-" not in path:
            raise OSError("gone")

    with monkeypatch.context() as m:  # the days are in the archive, and not yet out of the live folder
        m.setattr(sinks, "delete", fails)
        with pytest.raises(OSError):
            sinks.archive_events(spark, live, archived, "2024-01-10", 7)
    assert held(sinks.read_archived(spark, live, archived)) == want
    sinks.append_events(events(spark, [("f", "2024-01-01")]), live)  # a row comes late, while both hold its day
    want = sorted([*want, ("f", "2024-01-01", "live")])
    assert held(sinks.read_archived(spark, live, archived)) == want
    assert sinks.archive_events(spark, live, archived, "2024-01-10", 7) == ["2024-01-01"]
    want = sorted([(i, d, "archived" if i == "f" else p) for i, d, p in want])
    assert held(sinks.read_archived(spark, live, archived)) == want
    sinks.append_events(events(spark, [("g", "2024-01-01")]), live)  # and one after the day was moved
    assert sinks.archive_events(spark, live, archived, "2024-01-10", 7) == ["2024-01-01"] and sinks.archive_events(spark, live, archived, "2024-01-10", 7) == []
    assert held(sinks.read_archived(spark, live, archived)) == sorted([*want, ("g", "2024-01-01", "archived")])


def test_policies_for_bad_lines(spark, tmp_path):
    line = lambda i: json.dumps({"claim_type": "CLAIM", "signature": {"id": i}})
    files = {"a_claims.jsonl": [line("1"), "", line("2"), "{broken", line("3")], "b_claims.jsonl": [line("4"), "5", line("6")], "c_claims.jsonl": [line("7"), "   "], "d_claims.jsonl": ["[]"]}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    ids = lambda policy: sorted((r.source_name[0], r.signature.id) for r in records.read_claims(spark, str(tmp_path), policy).where("signature is not null").collect())
    assert ids("abort") == [("a", "1"), ("a", "2"), ("b", "4"), ("c", "7")]
    assert ids("drop") == ids("keep") == [("a", "1"), ("a", "2"), ("a", "3"), ("b", "4"), ("b", "6"), ("c", "7")]
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        records.read_claims(spark, str(tmp_path), "raise").collect()
    big = tmp_path / "big"
    big.mkdir()
    (big / "x_claims.jsonl").write_text("\n".join([line(str(i)) for i in range(4000)] + ["oops"] + [line(str(i)) for i in range(4000, 6000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        got = records.read_claims(spark, str(big), "abort")
        assert got.count() == 4000 and got.agg(F.max(F.col("signature.id").cast("int"))).first()[0] == 3999
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_observed_write(spark, tmp_path):
    rows = spark.createDataFrame([("ab",), ("c",), (None,)], "text string")
    assert sinks.write_logged(rows, str(tmp_path / "t"), "s") == {"stage": "s", "n": 3, "chars": 3, "preview": "ab"} and spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_responder_is_asked_once(spark, tmp_path):
    log, answers = tmp_path / "asked", str(tmp_path / "answers")
    log.mkdir()
    folder = str(log)

    def responder(batch):
        for p in batch:
            with open(os.path.join(folder, p), "a") as f:
                f.write("x")
        if len(batch) > 1 and "bad" in batch:
            raise RuntimeError("one of them is bad")
        if "bad" in batch:
            raise ValueError("bad")
        return [f"{p}!" if p != "none" else None for p in batch]

    rows = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "b", "a", "bad", None, "none", *(f"p{i}" for i in range(30))])], "i int, prompt string")
    got = {r.i: r.response for r in prompts.with_model_responses(rows, responder, answers, batch=4, wave=10).collect()}
    assert got == {i: None if p in (None, "bad", "none") else f"{p}!" for i, p in rows.collect()}
    errors = {r.error for r in spark.read.parquet(answers).where("response is null").collect()}
    assert errors == {"ValueError: bad", "no answer"}
    asked = {f: len((log / f).read_text()) for f in os.listdir(folder)}
    more = rows.unionByName(spark.createDataFrame([(99, "new")], "i int, prompt string"))
    again = {r.i: r.response for r in prompts.with_model_responses(more, responder, answers, batch=4, wave=10).collect()}
    assert again == {**got, 99: "new!"}
    assert {f: len((log / f).read_text()) - asked.get(f, 0) for f in os.listdir(folder) if f not in ("bad", "none")} == {f: int(f == "new") for f in os.listdir(folder) if f not in ("bad", "none")}
    recorded = spark.read.parquet(answers).select("prompt_hash", "response").where("response is not null")
    assert {r.i: r.response for r in prompts.with_model_responses(more, recorded).collect()} == again
    with pytest.raises(ValueError, match="folder"):
        prompts.with_model_responses(rows, responder)


def test_a_wave_reads_its_own_prompts(spark, tmp_path, monkeypatch):
    """What is read for a wave doesn't grow with the number of waves."""
    read, mapped = [], type(spark.range(1)).mapInPandas

    def counted(self, *a, **k):
        read.append(sum(os.path.getsize(f.removeprefix("file://")) for f in self.inputFiles()))
        return mapped(self, *a, **k)

    monkeypatch.setattr(type(spark.range(1)), "mapInPandas", counted)
    rows = spark.range(400).select(F.col("id").alias("i"), F.sha2(F.col("id").cast("string"), 512).alias("prompt"))
    got = {r.i: r.response for r in prompts.with_model_responses(rows, lambda batch: [p[:3] for p in batch], str(tmp_path / "answers"), batch=50, wave=100).collect()}
    assert got == {r.i: r.prompt[:3] for r in rows.collect()}
    assert len(read) == 4 and sum(read) < 2 * 400 * (64 + 128)


def test_bundle_lines_with_too_few_cells(spark):
    text = "| S-001 | IF a | THEN b |\n| S-002 |\n| S-003 | only |\nx"
    got = reports.parse_bundles(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string"), "doc_id").collect()
    assert [(r.id, r.condition, r.action, r.error) for r in got] == [("S-001", "IF a", "THEN b", None), ("S-002", None, None, "1 of 3 cells"), ("S-003", "only", None, "2 of 3 cells")]


def test_transcripts_and_spans(spark):
    segments = spark.createDataFrame([(1, 0, 0.0, "hi"), (1, 1, 75.9, "  "), (1, 2, 600.2, " yo ")], "doc_id int, seg_no int, start double, text string")
    assert prompts.format_transcript(segments, F.lit("VIDEO: t")).first().prompt == "VIDEO: t\n\n[0.0s] hi\n[75.9s]   \n[600.2s]  yo "
    assert prompts.timed_lines(segments).first().content == "[00:00] hi\n[10:00] yo"
    docs = spark.createDataFrame([(1,), (2,)], "doc_id int")
    assert {r.doc_id: r.span for r in prompts.timestamp_range(segments, docs).collect()} == {1: "0:00-10:00", 2: "0:00-0:00"}


def test_listings_and_index(spark):
    rows = spark.createDataFrame([(1, None, "a", "b", None), (2, 3, "c", "d", "f"), (3, 1, None, "e", "g")], "ord int, drawer int, condition string, action string, source_file string")
    assert [(r.pos, r.drawer, r.line) for r in reports.capped_listing(rows, 2).orderBy("pos").collect()] == [(1, 0, "- IF a → THEN b (unknown)"), (2, 1, "- IF  → THEN e (g)"), (3, None, "... and 1 more claims truncated")]
    assert reports.capped_listing(rows, 3).count() == 3
    clusters = spark.createDataFrame([(1, 7, "GAP", f"S-{i:03d}") for i in range(7)] + [(2, 8, "LOW", "S-100")], "drawer int, root int, topic string, id string")
    lines = {r.root: r.line for r in reports.theory_index(clusters, {1: "Bias"}).collect()}
    assert lines == {7: "- **Bias** | CLUSTER: GAP | Entries: S-000, S-001, S-002, S-003, S-004...", 8: "- **Drawer 2** | CLUSTER: LOW | Entries: S-100"}
    assert tuple(reports.theory_totals(clusters, rows).first()) == (8, 2, 3) and tuple(reports.theory_totals(clusters.limit(0), rows.limit(0)).first()) == (0, 0, 0)
    queue = spark.createDataFrame([(1, "DONE", "u", 1), (2, "QUEUED", None, 2), (3, "QUEUED", "u", 3), (4, "QUEUED", "u", 4)], "id int, status string, url string, position int")
    assert {r.id: r.action for r in reports.plan_queue(queue, 2).collect()} == {1: "done", 2: "skip", 3: "run", 4: "wait"}
    assert {r.id: r.action for r in reports.plan_queue(queue, dry_run=True).collect()} == {1: "done", 2: "skip", 3: "dry_run", 4: "dry_run"}


def test_scratch_tables_go(spark):
    with shared.scratch(spark):
        shared.materialise(spark.range(3), "inside")
        path = shared._OPEN[-1][0]
        assert os.path.isdir(path)
    assert not os.path.isdir(path)
    kept = shared.scratch_path(spark, "kept")
    shared.materialise(spark.range(3), "outside")
    shared.drop_scratch(spark)
    assert not os.path.isdir(os.path.dirname(kept))
