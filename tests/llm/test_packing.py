"""Best fit under three capacities that bind, against a plain loop; awkward rows."""

import numpy as np
import public_tokenizers as P
import pytest

from claimlake.llm import catalog, packing


def plain(needs, capacities, weights, rule):
    """The sequence of each piece by comparing it with every open sequence."""
    share = [[x / c for x, c in zip(row, capacities, strict=True)] for row in needs]
    order = sorted(range(len(share)), key=lambda i: (-max(share[i]), -share[i][0], i))
    bins, out = [], [None] * len(share)
    for i in order:
        best, at = None, None
        for b, room in enumerate(bins):
            left = [r - x for r, x in zip(room, share[i], strict=True)]
            if min(left) < -1e-12:
                continue
            score = sum(w * x * x for w, x in zip(weights, left, strict=True)) if rule == "norm" else -sum(w * r * x for w, r, x in zip(weights, room, share[i], strict=True))
            if best is None or score < best - 1e-12:
                best, at = score, b
        if at is None:
            at = len(bins)
            bins.append([1.0] * len(capacities))
        bins[at] = [r - x for r, x in zip(bins[at], share[i], strict=True)]
        out[i] = at
    return out


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacities", [(64, 64, 64**2), (64, 3, 64**2), (64, 64, 900), (64, 4, 700)])
def test_best_fit_equals_a_plain_loop(rule, capacities):
    rng = np.random.default_rng(sum(capacities))
    for weights in ((1.0, 1e-3, 1e-3), (1.0, 0.37, 0.61)):
        length = rng.integers(1, 25, 700)
        needs = np.stack([length, np.ones_like(length), length**2], axis=1).astype(float)
        got = packing.best_fit(needs, np.array(capacities, float), np.array(weights), rule)
        want = plain(needs.tolist(), capacities, weights, rule)
        assert got.tolist() == want
        used = [needs[got == b].sum(axis=0) for b in range(got.max() + 1)]
        assert all((u <= capacities).all() for u in used)
        # each capacity below the trivial one is what closes some sequence
        for c, bound in ((1, 64), (2, 64**2)):
            if capacities[c] < bound:
                assert max(u[c] for u in used) > 0.9 * capacities[c]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_documents_under_binding_capacities(spark, rule):
    texts = [None, "", "word " * 900, "x" * 5000, *(f"short text number {i} " * (i % 17) for i in range(120)), *["the same row"] * 5]
    docs = spark.createDataFrame([(1 if t == "the same row" else i, t, "p", 0) for i, t in enumerate(texts)], "doc_id long, text string, piece string, length int").repartition(4)
    pieces = packing.token_pieces(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, 64)
    packed = packing.pack(pieces, 256, max_documents=7, max_attention=9000, rule=rule).toPandas()
    assert len(packed) == pieces.count() and (packed.length <= 64).all()
    sums = packed.assign(cost=packed.length**2).groupby("sequence_id").agg(tokens=("length", "sum"), n=("length", "size"), cost=("cost", "sum"))
    assert sums.tokens.max() <= 256 and sums.n.max() == 7 and 8000 < sums.cost.max() <= 9000
    one = packed.sort_values(["length", "key", "piece", "start"], ascending=[False, True, True, True], kind="stable")
    needs = [[x, 1, x * x] for x in one.length.tolist()]
    want = plain(needs, (256, 7, 9000), (1.0, 1e-3, 1e-3), rule)
    assert len(sums) == max(want) + 1
    with pytest.raises(Exception, match="exceeds a capacity"):
        packing.pack(pieces, 256, max_attention=64**2 - 1).count()


def test_query_with_three_capacities(spark):
    packed = catalog.QUERIES["packing_three_capacities"](spark, "/root/testdata/sf0.01").toPandas()
    assert (packed.length <= catalog.SHORT_PIECE).all()
    sums = packed.assign(cost=packed.length**2).groupby("sequence_id").agg(tokens=("length", "sum"), n=("length", "size"), cost=("cost", "sum"))
    assert sums.tokens.max() <= 2048 and sums.n.max() == catalog.MOST_DOCUMENTS and 0.9 * catalog.MOST_ATTENTION < sums.cost.max() <= catalog.MOST_ATTENTION
    for _, own in packed.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
    cut = packed.groupby("doc_id").apply(lambda g: g.sort_values("piece").start.tolist() == [0, *g.sort_values("piece").length.cumsum().tolist()[:-1]], include_groups=False)
    assert cut.all() and len(cut) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
