"""Resampling against plain loops with zlib's crc32."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from claimlake.llm import importance

ODD = ["", None, "one", "Äpfel ÄPFEL äpfel naïve-naïve 日本語 日本語。と", "a" * 5000 + " b" * 40, "x\x00y\x7fz KK", "tail", "Tail", "the quick brown fox " * 30, "... --- !!!", "wort" * 30 + " " + "ab" * 40 + " " + "ba" * 40]


def features(text, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def expected(docs, target, percent, least, most, buckets, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for text in texts for f in features(text, most)[1]) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    rows = []
    for i, text in docs:
        words, found = features(text, most)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)])
    may = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {id(r): n for n, r in enumerate(may[: percent * len(may) // 100], 1)}
    return sorted(([*r[:4], drawn.get(id(r))] for r in rows), key=repr)


@pytest.mark.parametrize("most, least, percent, buckets", [(1, 1, 40, 10_000), (3, 2, 100, 97), (2, 20, 10, 1000)])
def test_equals_plain_loops(spark, most, least, percent, buckets):
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefghé0"), n)) for n in rng.integers(1, 30, 60)]
    texts = ODD + [" ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(150)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "a lone row " * 9)]
    target = [" ".join(rng.choice(vocabulary[:20], 30)) for _ in range(10)] + [None, ""]
    table = spark.createDataFrame([(i, t, 0, 1.0) for i, t in docs], "doc_id long, text string, score int, rank double").repartition(7)
    goal = spark.createDataFrame([(t, 3) for t in target], "text string, doc_id int")
    got = importance.resample(table, goal, percent, least, most, buckets, seed="2024")
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(([*r] for r in got.collect()), key=repr) == expected(docs, target, percent, least, most, buckets, "2024")


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(7, "the same words again and again")] * 6, "doc_id long, text string")
    goal = spark.createDataFrame([("words", 1)], "text string, n int")
    ranks = [r["rank"] for r in importance.resample(docs, goal, percent=50, least_words=3).collect()]
    assert sorted(r for r in ranks if r) == [1, 2, 3] and ranks.count(None) == 3
    assert importance.resample(docs.where("doc_id < 0"), goal).count() == 0
    assert importance.resample(docs, goal.where("n = 2"), percent=100, least_words=1).where("rank is not null").count() == 6


def test_matrices_hold_every_length():
    words = ["a", *("ab" * n for n in range(1, 60)), *("é" * n for n in range(1, 60)), "x" * 700, "x" * 700, "y" * 700]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    lengths = np.array([len(w.encode()) for w in words])
    starts = np.cumsum(lengths) - lengths
    assert importance.bucketed(data, starts, lengths, 10_000).tolist() == [zlib.crc32(w.encode()) % 10_000 for w in words]
    found, owner, n = importance.features_of(pa.array(["a b", None, "", "c"]).slice(1), 2, 50)
    assert (found.tolist(), owner.tolist(), n.tolist()) == ([zlib.crc32(b"c") % 50], [2], [0, 0, 1])
