import json

import pytest
from pyspark.sql import functions as F

from claimlake.operators import prompts, reports
from claimlake.sources import records, sinks


def test_tolerant_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "A", "pattern": "x"}\n\nnot json\n{"id": "B", "pattern": "y"}\n')
    assert [r.id for r in records.read_lexicon(spark, str(tmp_path / "a.jsonl")).orderBy("id").collect()] == ["A", "B"]
    assert records.read_index(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("schön\nzwei")
    (tmp_path / "in" / "b.md").write_bytes(b"\xff\xfe\xfa")
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.error) for r in records.ingest_dir(spark, str(tmp_path / "in")).collect()}
    assert got == {"a.md": ("schön\nzwei", None), "b.md": (None, "not UTF-8")}
    assert records.read_binary_b64(spark, str(tmp_path / "in"), "b.md").first().content == "//76"
    assert records.read_documents(spark, str(tmp_path / "in"), "a.md").first().text == "schön\nzwei"


def test_queue(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps({"queue": [{"id": "v1", "status": "QUEUED"}, {"id": "v2", "status": "DONE"}]}))
    assert [r.id for r in records.read_queue(spark, str(tmp_path / "q.json")).where("status = 'QUEUED'").collect()] == ["v1"]
    with pytest.raises(Exception):  # noqa: B017
        records.read_queue(spark, str(tmp_path / "none.json")).count()


def test_replace_and_bundles(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5):
        sinks.replace_table(spark.range(n), path)
    assert sinks.read_replaced(spark, path).count() == 5
    sinks.write_bundles(spark.createDataFrame([("B-1", "# one", 2), ("B-2", "# two", 0)], "bundle_id string, text string, validated int"), str(tmp_path / "b"))
    assert {(r.bundle_id, r.validated) for r in records.read_index(spark, str(tmp_path / "b" / "index")).collect()} == {("B-1", 2), ("B-2", 0)}


def test_archive_keeps_unreadable_days(spark):
    live, archived = sinks.split_archive(spark.createDataFrame([("2024-01-01",), ("2024-01-09",), ("odd",), (None,)], "session_date string"), "2024-01-10", 7)
    assert live.count() == 3 and archived.first().session_date == "2024-01-01"


def test_parsers(spark):
    rows = spark.createDataFrame([('{"concept_id": "c", "status": "FOUND"}\nnoise\n{"status": "x"}', '```json\n{"a": 1}\n```', '{"content": [{"type": "text", "text": "x"}, {"type": "tool"}, {"type": "text", "text": "y"}], "usage": {"input_tokens": 3}}'), ("", "broken {", "{}")], "l string, o string, r string")
    got = rows.select(prompts.parse_llm_lines(F.col("l")).alias("l"), prompts.parse_llm_object(F.col("o"), "a int").alias("o"), prompts.parse_response(F.col("r")).alias("r")).collect()
    assert [x.concept_id for x in got[0].l] == ["c"] and got[1].l == []
    assert got[0].o.value.a == 1 and got[0].o.error is None and got[1].o.error == "invalid JSON" and got[1].o.raw == "broken {"
    assert tuple(got[0].r) == ("xy", 3, 0) and tuple(got[1].r) == ("", 0, 0)


def test_transcript_shapes(spark):
    payloads = [(1, '{"content": "all"}'), (2, '{"content": ["a ", "b"]}'), (3, '{"content": [{"offset": 1500, "text": " x "}, {"text": " "}]}'), (4, "bad"), (5, "{}")]
    got = prompts.normalize_transcript(spark.createDataFrame(payloads, "doc_id int, payload string")).orderBy("doc_id", "seg_no").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0.0, "all"), (2, 0, 0.0, "a"), (2, 1, 0.0, "b"), (3, 0, 1.5, "x")]


def test_prompts(spark):
    described = spark.createDataFrame([(1, 2, "chart"), (1, 3, "photo")], "doc_id int, page_num int, description string")
    text = spark.createDataFrame([(1, 2, "words")], "doc_id int, page_num int, text string")
    assert prompts.format_visual(described, text).first().prompt == "VISUAL CONTENT (page 2):\nPAGE TEXT:\nwords\nchart\n---\n\nVISUAL CONTENT (page 3):\nphoto"
    answered = prompts.with_model_responses(spark.createDataFrame([("p",), ("q",)], "prompt string"), spark.createDataFrame([("148de9c5a7a44d19e56cd9ae1a554bf67847afb0c58f6e12fa29ac7ddfca9940", "yes")], "prompt_hash string, response string"))
    assert {(r.prompt, r.response) for r in answered.collect()} == {("p", "yes"), ("q", None)}


def test_theory_and_sinks(spark):
    clusters = spark.createDataFrame([(1, 1, "A_B", "S-1"), (1, 1, "A_B", "S-2"), (2, 9, "C", "S-9")], "drawer int, root int, topic string, id string")
    got = {r.drawer: r.text for r in reports.render_theory(clusters, spark.createDataFrame([(1,)], "drawer int")).collect()}
    assert got == {1: "## 1\n- A_B (2): S-1, S-2\n1 negatives\n", 2: "## 2\n- C (1): S-9\n0 negatives\n"}
    assert sinks.to_markdown(spark.createDataFrame([("a|b", None)], "x string, y int")).first().value == "| a\\|b | — |"
    assert tuple(sinks.stage_log(spark.createDataFrame([("ab",), ("c",)], "text string"), "s").first()) == ("s", 2, 3, "ab")


def test_tiers_results_and_ids(spark):
    rows = spark.createDataFrame([("a/Layer_0/x.md",), ("b/guide.md",), (None,)], "path string")
    tiers = rows.select(records.source_tier(F.col("path"), (("CANON", ("layer_0",)), ("FIRST", ("guide",)))).alias("t")).collect()
    assert [r.t for r in tiers] == ["CANON", "FIRST", "LATERAL"]
    results = spark.createDataFrame([(1, 1, None, [("c", "FOUND"), ("d", "ABSENT")]), (1, 2, "failed", [("e", "FOUND")]), (2, 1, None, [])], "doc_id int, drawer int, error string, concepts array<struct<concept_id:string,status:string>>")
    assert {tuple(r) for r in reports.explode_results(results).collect()} == {(1, 1, "c", "FOUND"), (1, 1, "d", "ABSENT")}
    ids = spark.createDataFrame([("x", 2), ("x", 1), ("y", 5)], "p string, o int").withColumn("id", reports.seq_id("S", ["p"], ["o"])).collect()
    assert {(r.p, r.o): r.id for r in ids} == {("x", 1): "S-001", ("x", 2): "S-002", ("y", 5): "S-001"}
