"""Lexicons of any size against plain loops: needles in texts, cosines, shared words."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimlake.operators import joins, matching, reports

rng = random.Random(11)
WORDS = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 4))) for _ in range(40)]
TEXTS = [None, "", "a", "aaaa", *(" ".join(rng.choices(WORDS, k=rng.randint(1, 30))) for _ in range(60))]
NEEDLES = [*((i, rng.choice(WORDS) + rng.choice(["", " ", rng.choice(WORDS)])) for i in range(300)), (7, "aa"), (7, "aaa"), (8, ""), (9, None), (None, "a"), (5, "Aa")]


@pytest.mark.parametrize("most, chars", [(10_000, None), (3, None), (3, 40)])
@pytest.mark.parametrize("count", [0, 10, 306])
def test_needles_equal_plain_loops(spark, most, chars, count):
    needles = NEEDLES[-count:] if count else []
    rows = spark.createDataFrame([(i, t, TEXTS[-i] if i % 3 else None) for i, t in enumerate(TEXTS)], "i int, one string, two string").repartition(3)
    lexicon = spark.createDataFrame(needles, "name int, needle string")
    got = {r.i: Counter(r.found) for r in matching.found_in(rows, ["one", "two"], lexicon, "found", most, chars).collect()}
    assert got == {i: Counter(n for n, x in needles if x is not None and any(t is not None and x in t for t in (one, TEXTS[-i] if i % 3 else None))) for i, one in enumerate(TEXTS)}


def test_large_lexicon_has_no_nested_loop(spark):
    """200,000 needles are one pass of Arrow batches; the plan joins nothing."""
    docs = spark.createDataFrame([(i, f"the needle{i:06d}x and needle{199_999 - i:06d}y") for i in range(50)], "doc_id int, text string")
    vectors = spark.range(200_000).select(F.col("id"), F.format_string("NEEDLE%06d", "id").alias("pattern"))
    found = joins.pattern_match(docs, vectors, "doc_id", "text", distinct=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan
    assert {(r.doc_id, r.pattern_id) for r in found.collect()} == {(i, n) for i in range(50) for n in (i, 199_999 - i)}


@pytest.mark.parametrize("size", [10, 1_000_000])
def test_cosines_equal_plain_loops(spark, size):
    lines = [(i, rng.choices(WORDS, k=rng.randint(0, 6))) for i in range(40)]
    rows = [(i, (t or "").split()[:8] if t is not None else None) for i, t in enumerate(TEXTS)]
    got = matching.cosines(spark.createDataFrame(rows, "i int, words array<string>"), "i", "words", spark.createDataFrame(lines, "line_id int, words array<string>"), 0.5, size).collect()
    want = {}
    for i, a in rows:
        for j, b in lines:
            x, y = Counter(a or ()), Counter(b)
            dot = sum(x[w] * y[w] for w in x)
            if dot and dot / (math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))) >= 0.5:
                want[i, j] = dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    assert {(r.i, r.line_id) for r in got} == set(want) and all(abs(want[r.i, r.line_id] - r.similarity) < 1e-12 for r in got)


@pytest.mark.parametrize("size", [12, 1_000_000])
def test_first_overlap_equals_plain_loops(spark, size):
    pick = lambda k: rng.sample(sorted(set(WORDS))[:25], k)
    rows = [(i, sorted(rng.sample(range(4), rng.randint(0, 3))), pick(rng.randint(0, 9))) for i in range(60)]
    lines = [(rng.randrange(4), i, pick(rng.randint(0, 9))) for i in range(50)]
    got = matching.first_overlaps(spark.createDataFrame(rows, "id int, groups array<int>, words array<string>"), spark.createDataFrame(lines, "group_no int, line_no int, words array<string>"), 3, size)
    want = {}
    for i, groups, words in rows:
        hits = sorted((g, n) for g, n, w in lines if g in groups and len(set(w) & set(words)) >= 3)
        if hits:
            want[i] = hits[0]
    assert {r.id: (r.group_no, r.line_no) for r in got.collect()} == want


def test_semantic_match_of_texts_without_words(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "one two two")], "doc_id int, text string")
    vectors = spark.createDataFrame([("a", "two two ONE"), ("b", None), ("c", "...")], "id string, pattern string")
    assert [tuple(r) for r in reports.semantic_match(docs, vectors, 0.9).collect()] == [(3, "a", 1.0)]


def test_lookup_beyond_the_broadcast_bound(spark):
    prices = spark.range(joins.MOST_LEXICON_ROWS + 1).select(F.col("id").cast("string").alias("model"), F.lit(1.0).alias("input_per_m"), F.lit(2.0).alias("output_per_m"))
    usage = spark.createDataFrame([("5", 1_000_000, None), ("x", 1, 1)], "model string, prompt_tokens long, completion_tokens long")
    assert [r.cost_usd for r in joins.call_cost(usage, prices).collect()] == [1.0]
    routes = prices.select(F.lit("default").alias("tier"), F.col("model").alias("role"), F.lit("m").alias("model"))
    assert joins.route_models(spark.createDataFrame([("gold", "7")], "tier string, role string"), routes).first().model == "m"


def test_batches_in_slices_of_few_words():
    lists = [["a"] * n for n in (3, 0, 4, 9, 1, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(lists, pa.list_(pa.string()))], ["id", "words"])
    slices = [s.to_pydict() for s in matching.few_words(iter([batch, batch.slice(0, 0)]), 1, 7)]
    assert [s["id"] for s in slices] == [[0, 1, 2], [3], [4, 5, 6]]
    assert [w for s in slices for w in s["words"]] == lists
