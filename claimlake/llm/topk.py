"""Exact top-k inner-product search in three phases with a uniform threshold.

The dimensions are dealt into lists; a vector's score is the sum of its partial scores in them. (1) Every block of
candidates gathers the local list of one of the lists in turn, each query's highest partial scores in it, and scores these entries in full: the k-th best
of all is a cutoff that the k-th best score can't fall below. (2) With the cutoff in hand, each block collects the
entries that reach cutoff / lists in some list; any other entry sums to less than the cutoff. Candidates whose norm in a list keeps them below for every query aren't multiplied.
(3) Only the entries collected are scored in full, and each block gives its k best.

Candidates stay where they are, dealt once into parts of bounded size; the queries, a stated set, travel to them in blocks. A task holds one part and one block of queries.

Components become floor(scale * x). Scores are exact: float64 products where all of a block's sums stay below 2**53, Python integers
elsewhere; a score of a result beyond 64 bits raises OverflowError. Ties go to
the smaller id. Vectors that are null, empty, of another length than the most frequent one, or hold null or non-finite
components take no part, neither as query nor candidate; nor do rows without an id. A query gets all candidates if there are fewer than k. Ids that
occur more than once are each a candidate, but a query's own id never is; a repeated query id is answered once, for its smallest vector.
Extra columns are ignored, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise

#: Bytes of the vectors of a block of queries and of candidates, and of a part of the candidates, in doubles; and the most rows of a block, whose scores are one matrix.
QUERY_BYTES, CANDIDATE_BYTES, PART_BYTES = 1 << 18, 1 << 22, 1 << 25
MOST_QUERIES, MOST_CANDIDATES = 512, 8192
LISTS = 4
#: Whole numbers that float64 holds exactly; and entries that are scored in full at once.
EXACT, AT_ONCE = 2.0**53, 1 << 16


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): usable vectors as arrays of whole doubles."""

    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    bad = F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) == float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ~F.coalesce(bad, F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(F.col(vector_col), whole).alias("v"))


BLOCK = "block bigint, ids binary, matrix binary, cutoffs binary, known binary"


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, v, cutoff) packed, within their partitions, into matrices of at most `size` rows, sorted by id."""
    names = [f.split()[0] for f in BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cutoff = batch.column("cutoff")
            own = [batch.column("vec_id").to_numpy(), batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1), cutoff.fill_null(0).to_numpy(), cutoff.is_valid().to_numpy(zero_copy_only=False)]
            held = [np.concatenate(x) for x in zip(held, own, strict=True)] if held else own
            while len(held[0]) >= size:
                yield block(number, [x[:size] for x in held])
                held, number = [x[size:] for x in held], number + 1
        if held and len(held[0]):
            yield block(number, held)

    def block(number: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        order = np.argsort(columns[0], kind="stable")
        return pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([np.ascontiguousarray(x[order]).tobytes()]) for x in columns)], names)

    return rows.mapInArrow(run, BLOCK)


def exact_pair(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as float64 if no sum of their products can leave its whole numbers, else as Python integers."""
    if queries.shape[1] * np.abs(queries).max(initial=0.0) * np.abs(candidates).max(initial=0.0) < EXACT:
        return queries, candidates
    return tuple(np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape) for m in (queries, candidates))


def heads(score: np.ndarray, k: int, barred: np.ndarray) -> np.ndarray:
    """Which entries are among the k highest of their row, but for those barred; ties go to the smaller position."""
    score = np.where(barred, -np.inf, score)
    n = score.shape[1]
    if n <= k:
        return ~barred
    least = np.sort(score, axis=1)[:, n - k] if score.dtype == object else np.partition(score, n - k, axis=1)[:, n - k]
    above, tie = score > least[:, None], (score == least[:, None]) & ~barred
    missing = k - above.sum(axis=1)
    many = np.flatnonzero(tie.sum(axis=1) > missing)
    tie[many] &= np.cumsum(tie[many], axis=1) <= missing[many, None]
    return above | tie


def full_scores(queries: np.ndarray, candidates: np.ndarray, line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Scores of the entries (line, at) alone."""
    pieces = [(queries[line[i : i + AT_ONCE]] * candidates[at[i : i + AT_ONCE]]).sum(axis=1) for i in range(0, len(line), AT_ONCE)]
    return np.concatenate(pieces) if pieces else np.empty(0)


def split_dims(n: int, lists: int) -> list[slice]:
    bounds = np.linspace(0, n, min(lists, n) + 1).astype(int)
    return [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def gathered(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, k: int, dims: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase 1, (query, candidate, score): the entries that head one list."""
    line, at = np.nonzero(heads(queries[:, dims] @ candidates[:, dims].T, k, own))
    return line, at, full_scores(queries, candidates, line, at)


def collected(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, cutoff: np.ndarray, known: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 2, (query, candidate): the entries that reach their query's cutoff / lists in some list; all where there is no cutoff."""
    dims = split_dims(queries.shape[1], lists)
    enough = np.repeat(~known[:, None], len(candidates), axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for part in dims:
            norms = [np.sqrt((m[:, part].astype(float) ** 2).sum(axis=1)) for m in (queries, candidates)]
            least = cutoff.astype(float) / len(dims)
            reach = np.where(least > 0, norms[0] / least, np.inf)[known]  # a candidate's norm times this has to be 1 at least
            may = norms[1] * reach.max(initial=0.0) > 1 - 1e-9 if np.isfinite(reach).all() else np.ones(len(candidates), bool)
            cols = np.flatnonzero(may)
            enough[:, cols] |= (queries[:, part] @ candidates[cols, part].T) * len(dims) >= cutoff[:, None]
    return np.nonzero(enough & ~own)


def _rows(query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(ids, pa.int64()), pa.array([int(s) for s in score.tolist()], pa.int64())], ["query_id", "vec_id", "score"])


FOUND = "query_id bigint, vec_id bigint, score bigint"


def _met(answer):
    """Of rows sorted by part, candidates first: what each block of queries finds in each block of its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != current:
                    current, held = row["part"], []
                ids = np.frombuffer(row["ids"], np.int64)
                matrix = np.frombuffer(row["matrix"]).reshape(len(ids), -1)
                if not row["asks"]:
                    held.append((row["block"], ids, matrix))
                    continue
                cutoff, known = np.frombuffer(row["cutoffs"], np.int64), np.frombuffer(row["known"], bool)
                for block, others, candidates in held:
                    yield _rows(*answer(block, ids, *exact_pair(matrix, candidates), others, cutoff, known))

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k highest scores against all vectors but its own."""
    spark = vectors.sparkSession
    candidates = quantised(vectors, id_col, vector_col, scale)
    length = [r[0] for r in candidates.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()]
    dims = length[0] if length else 0
    fits = F.size("v") == F.lit(dims)
    # as many vectors as there is room for, so that wide ones don't take more memory
    rows_of = lambda size, most: max(1, min(most, size // (8 * max(1, dims))))
    query_block, candidate_block, part = rows_of(QUERY_BYTES, MOST_QUERIES), rows_of(CANDIDATE_BYTES, MOST_CANDIDATES), rows_of(PART_BYTES, PART_BYTES)
    no_cutoff = F.lit(None).cast("long").alias("cutoff")
    blocks = materialise(_blocks(candidates.where(fits).select("vec_id", "v", no_cutoff), candidate_block), "blocks")
    size = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("ids")), F.lit(0)) / 8).first()
    parts = int(max(1, -(-size[1] // part), min(size[0], spark.sparkContext.defaultParallelism)))
    asked = materialise(quantised(queries, id_col, vector_col, scale).where(fits).groupBy("vec_id").agg(F.min("v").alias("v")), "asked")

    def meet(with_cutoffs: DataFrame, answer) -> DataFrame:
        here = blocks.select(F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part"), F.lit(False).alias("asks"), "*")
        there = _blocks(with_cutoffs, query_block).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), F.lit(True).alias("asks"), "*")
        return here.unionByName(there).repartition(parts, "part").sortWithinPartitions("part", "asks").mapInArrow(_met(answer), FOUND)

    def gather(block, ids, q, c, others, cutoff, known):
        dims = split_dims(q.shape[1], lists)
        line, at, score = gathered(q, c, ids[:, None] == others[None, :], k, dims[block % len(dims)])
        return ids[line], others[at], score

    def resolve(block, ids, q, c, others, cutoff, known):
        line, at = collected(q, c, ids[:, None] == others[None, :], cutoff, known, lists)
        score = full_scores(q, c, line, at)
        first = np.lexsort((others[at], -score, line))
        rank = np.arange(len(first)) - np.searchsorted(line[first], line[first])
        best = first[rank < k]
        return ids[line[best]], others[at[best]], score[best]

    cutoffs = _ranked(meet(asked.select("vec_id", "v", no_cutoff), gather), k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("cutoff"))
    found = meet(asked.join(materialise(cutoffs, "cutoffs"), "vec_id", "left").select("vec_id", "v", "cutoff"), resolve)
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
