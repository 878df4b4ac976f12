import pytest
from pyspark.sql import functions as F

from claimlake.operators import chunking


def greedy(texts, most, close=1 << 60):
    """Lists of places, by the plain loop."""
    out, now, total = [], [], 0
    for i, t in enumerate(texts):
        if len(t) > most:
            out += [now] if now else []
            out.append([i])
            now, total = [], 0
            continue
        if now and total + len(t) > most:
            out.append(now)
            now, total = [], 0
        now, total = [*now, i], total + len(t)
        if len(t) >= close:
            out.append(now)
            now, total = [], 0
    return out + ([now] if now else [])


@pytest.mark.parametrize(("most", "close"), [(10, 1 << 60), (20, 7), (1, 1 << 60)])
def test_packing(spark, most, close):
    texts = ["a" * n for n in (3, 4, 9, 1, 12, 2, 2, 2, 25, 7, 7, 10, 1)]
    parts = spark.createDataFrame([(1, i, len(t)) for i, t in enumerate(texts)], "doc_id int, part int, size int")
    starts = chunking.pack_starts(parts, ["doc_id"], "part", most, close).first().starts
    assert starts == [c[0] for c in greedy(texts, most, close)]


def test_pages(spark):
    pages = [(1, 1, "a" * 6), (1, 2, " "), (1, 3, "b" * 6), (1, 4, "x\n\n" + "y" * 12), (1, 5, "c"), (1, 6, "")]
    got = chunking.chunk_pages(spark.createDataFrame(pages, "doc_id int, page_num int, text string"), 10).orderBy("chunk_num").collect()
    assert [(r.text, r.page_start, r.page_end) for r in got] == [("a" * 6, 1, 2), ("b" * 6, 3, 3), ("x", 4, 4), ("y" * 12, 4, 4), ("c", 5, 6)]


def test_sections(spark):
    docs = spark.createDataFrame([(1, "lost\n# A\none\n\n## B\n\ntwo"), (2, "plain"), (3, None), (4, "")], "doc_id int, text string")
    got = {(r.doc_id, r.sec_no): (r.level, r.title, r.content, r.line_start) for r in chunking.md_sections(docs).collect()}
    assert got == {(1, 1): (1, "A", "one", 2), (1, 2): (2, "B", "two", 5), (2, 0): (0, "(No heading)", "plain", 1), (4, 0): (0, "(No heading)", "", 1)}
    chunks = chunking.chunk_sections(chunking.md_sections(docs)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.section) for r in chunks] == [(1, "# A\none\n\n## B\ntwo", "A"), (2, " (No heading)\nplain", "(No heading)")]


def test_transcript(spark):
    rows = [(1, i, i * 30.0, f"t{i}") for i in range(6)]
    got = chunking.chunk_transcript(spark.createDataFrame(rows, "doc_id int, seg_no int, start double, text string"), 60, 30).orderBy("chunk_no").collect()
    assert [(r.start, r.end, r.text) for r in got] == [(0.0, 60.0, "t0 t1 t2"), (60.0, 120.0, "t2 t3 t4"), (120.0, 150.0, "t4 t5")]


def test_size(spark):
    text = "ab. " * 300
    rows = chunking.chunk_by_size(spark.createDataFrame([(1, text), (2, None), (3, "  ")], "doc_id int, text string"), 100, 10).where("doc_id = 1").orderBy("chunk_num").collect()
    assert rows[0].start == 0 and text.rstrip().endswith(rows[-1].text)
    assert all(a.start + 100 >= b.start > a.start for a, b in zip(rows, rows[1:]))
    assert chunking.chunk_by_size(spark.createDataFrame([(2, None), (3, "  ")], "doc_id int, text string"), 100, 10).where(F.col("doc_id") > 0).count() == 0
