"""Whitening of embeddings on their principal components, which QDWH spectral divide and conquer finds.

Spark gathers sums, and centred products, of the distinct vectors; the driver splits their covariance, a matrix of one row and column for each dimension
and nothing that grows with the rows. The polar factor U of V - shift gives the projector (U + 1) / 2 on the eigenvalues above the shift; its range and
its complement are invariant subspaces, which are split in turn until each has one dimension. Subspaces below the components asked for are left whole. The components go
to all tasks.

Each entry c of a vector becomes the whole number floor(scale * c) + offset. Rows whose vector is null or empty, holds null or non-finite entries, or has another length than the
most frequent one (the greater of two) take no part and have no result; so has an empty table. Equal vectors count once in the fit, yet every row has its result, repeated and
null ids included. Entries that leave 62 bits are held at them. Centred entries n * x - S and deviations are exact whole numbers; a deviation beyond 64 bits is null. A component whose variance
is zero, or so small that rounding alone may have made it (a share of dimensions * 2**-52 of the largest), has no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise

EPS = 2.0**-52
#: Vectors of one product or result, rows of the covariance that travel together, and the size whole numbers are held at.
BLOCK, STRIP, MOST = 4096, 16, 2**62


# ---- whole vectors


def _usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable, lengths, starts): which vectors have neither nulls nor non-finite entries, and where each is in the flattened column."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    values = column.flatten()
    bad = np.flatnonzero(~np.isfinite(values.cast(pa.float64()).to_numpy(zero_copy_only=False)) | values.is_null().to_numpy(zero_copy_only=False))
    usable = lengths > 0
    usable[np.searchsorted(starts + lengths, bad, "right")] = False
    return usable, lengths, starts


def whole(column: pa.Array, dims: int, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """(which vectors are usable and of `dims` entries, these as a matrix of whole numbers)."""
    usable, lengths, starts = _usable(column)
    usable &= lengths == dims
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    matrix = values[starts[usable][:, None] + np.arange(dims)]
    with np.errstate(over="ignore"):
        return usable, np.clip(np.floor(scale * matrix), -float(MOST), float(MOST)).astype(np.int64) + offset


def most_frequent_length(vectors: DataFrame, vector_col: str) -> int:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, lengths, _ = _usable(batch.column(0))
            found, n = np.unique(lengths[usable], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["dims", "n"])

    counted = vectors.select(vector_col).mapInArrow(run, "dims bigint, n bigint").groupBy("dims").agg(F.sum("n").alias("n"))
    first = counted.orderBy(F.desc("n"), F.desc("dims")).first()
    return first["dims"] if first else 0


def distinct_vectors(vectors: DataFrame, vector_col: str, dims: int, scale: int, offset: int) -> DataFrame:
    """(x): each distinct whole vector once, as bytes of 64-bit numbers; copies meet within their tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, matrix = whole(batch.column(0), dims, scale, offset)
            rows = {row.tobytes() for row in matrix}
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.binary())], ["x"])

    return vectors.select(vector_col).mapInArrow(run, "x binary").distinct()


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """The vectors of distinct_vectors in matrices of at most BLOCK rows."""
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            yield np.frombuffer(b"".join(batch.column(0)[begin : begin + BLOCK].to_pylist()), np.int64).reshape(-1, dims)


# ---- sums and products over all vectors


def exact_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """(number of vectors, sum of each dimension), exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, object), np.zeros(dims, object)
        for x in _matrices(batches, dims):
            # halves of 32 bits, whose sums over a block stay within 64
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), *(pa.array([int(v) for v in s], pa.int64()) for s in (high, low))], ["dim", "n", "high", "low"])

    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = fit.mapInArrow(run, "dim int, n bigint, high bigint, low bigint").groupBy("dim").agg(F.sum("n").alias("n"), total("high"), total("low")).collect()
    sums = {r["dim"]: (int(r["high"]) << 32) + int(r["low"]) for r in rows}
    return (rows[0]["n"], [sums[i] for i in range(dims)]) if rows else (0, [0] * dims)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit numbers where these suffice, Python integers elsewhere."""
    if float(n) * float(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0) < MOST:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(y: np.ndarray) -> list[int | None]:
    """Sums of squares of rows of centred vectors; null beyond 64 bits."""
    largest = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    if y.shape[1] * largest**2 < MOST:
        return (y * y).sum(axis=1).tolist()
    exact = y.astype(object)
    return [s if s < 2**63 else None for s in (int(v) for v in (exact * exact).sum(axis=1))]


def covariance(fit: DataFrame, dims: int, n: int, sums: list[int], projection: np.ndarray | None = None) -> np.ndarray:
    """Covariance, divisor n, of the vectors centred beforehand, or of their projections.

    A task adds up its products, and gives strips of their rows, which meet by strip: no task gets more than a strip of each.
    """
    size = dims if projection is None else projection.shape[1]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _matrices(batches, dims):
            y = centred(x, n, sums).astype(np.float64) / n
            y = y if projection is None else y @ projection
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            starts = range(0, size, STRIP)
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int32()), pa.array([part] * len(starts), pa.int32()), pa.array([total[i : i + STRIP].tobytes() for i in starts], pa.binary())], ["strip", "part", "rows"])

    def added(strips: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, total = None, 0.0
        for batch in strips:
            for of, rows in zip(batch.column("strip").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                if of != strip and strip is not None:
                    yield row(strip, total)
                strip, total = of, np.frombuffer(rows) + (total if of == strip else 0.0)
        if strip is not None:
            yield row(strip, total)

    def row(strip: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([strip], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["strip", "rows"])

    met = fit.mapInArrow(products, "strip int, part int, rows binary").repartition("strip").sortWithinPartitions("strip", "part")
    strips = sorted(met.mapInArrow(added, "strip int, rows binary").collect())
    found = np.concatenate([np.frombuffer(bytes(r["rows"])).reshape(-1, size) for r in strips])
    return (found + found.T) / (2 * n)


# ---- spectral divide and conquer, of a matrix of the dimensions alone


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps: with QR while the weights are large, with Cholesky then.

    The lower bound of the singular values starts at the unit roundoff, at which six or seven steps converge whatever the matrix.
    """
    x = a / np.linalg.norm(a)
    least, one = EPS, np.eye(len(a))
    for _ in range(20):
        square = least * least
        d = np.cbrt(4 * (1 - square) / square**2) if square < 1 else 0.0
        root = np.sqrt(1 + d)
        alpha = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root))
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        before = x
        if gamma > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(gamma) * x, one]))
            x = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * (q[: len(a)] @ q[len(a) :].T)
        else:
            lower = np.linalg.cholesky(one + gamma * (x.T @ x))
            x = beta / gamma * x + (alpha - beta / gamma) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        x = (x + x.T) / 2
        least = min(1.0, least * (alpha + beta * square) / (1 + gamma * square))
        if abs(1 - least) < 10 * EPS and np.linalg.norm(x - before) < EPS ** (1 / 3):
            break
    return x


def split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of a above and below a shift; None if all eigenvalues are equal but for rounding at this scale."""
    one, values = np.eye(len(a)), np.diagonal(a)
    mean = values.mean()
    spread = np.linalg.norm(a - mean * one)
    if spread <= len(a) * EPS * scale:
        return None
    best, least = None, np.inf
    # The median, as the diagonal shows it, halves the work. The mean is always between the outer eigenvalues; those beside it serve where a shift is itself one.
    for shift in (np.median(values), *(mean + part * spread / np.sqrt(len(a)) for part in (0.0, 0.11, -0.17, 0.23, -0.31))):
        projector = (polar(a - shift * one) + one) / 2
        above = int(round(np.trace(projector)))
        if not 0 < above < len(a):
            continue
        start = projector[:, np.argsort(-np.diagonal(projector), kind="stable")[:above]]
        for _ in range(3):  # subspace iteration with a projector settles at once, unless the start was near-singular
            basis, _ = np.linalg.qr(start, mode="complete")
            first, second = basis[:, :above], basis[:, above:]
            rest = np.linalg.norm(second.T @ a @ first)
            if rest < least:
                best, least = (first, second), rest
            if least <= 8 * len(a) * EPS * scale:
                return best
            start = projector @ first
    return best


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a covariance, by falling eigenvalue, `most` at most."""
    scale = float(np.linalg.norm(v))
    done: list[np.ndarray] = []
    open_ = [np.eye(len(v))] if scale else []
    while open_ and sum(q.shape[1] for q in done) < most:
        basis = open_.pop()
        block = basis.T @ v @ basis
        parts = split((block + block.T) / 2, scale) if basis.shape[1] > 1 else None
        if parts is None:
            done.append(basis)
        else:  # the subspace of the greater eigenvalues is next
            open_ += [basis @ parts[1], basis @ parts[0]]
    if not done:
        return np.zeros(0), np.zeros((len(v), 0))
    vectors, _ = np.linalg.qr(np.hstack(done))
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > len(v) * EPS * values.max()]
    return values[order], vectors[:, order]


# ---- the operator


def whiten(vectors: DataFrame, most: int = 16, scale: int = 64, offset: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component."""
    dims = most_frequent_length(vectors, vector_col)
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not dims:
        return vectors.sparkSession.createDataFrame([], schema)
    fit = materialise(distinct_vectors(vectors, vector_col, dims, scale, offset), "distinct_vectors")
    n, sums = exact_sums(fit, dims)
    v = covariance(fit, dims, n, sums)
    values, basis = components(v, most)
    if not len(values):
        return vectors.sparkSession.createDataFrame([], schema)
    projection = basis / np.sqrt(values)
    error = float(np.abs(covariance(fit, dims, n, sums, projection) - np.eye(len(values))).max())
    explained, k = values / np.trace(v), len(values)
    broadcast = vectors.sparkSession.sparkContext.broadcast((projection, sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection, sums = broadcast.value
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(begin, BLOCK)
                usable, x = whole(rows.column(1), dims, scale, offset)
                y, at = centred(x, n, sums), np.repeat(np.flatnonzero(usable), k)
                times = lambda each: pa.array(np.tile(each, len(x)))
                deviation = pa.array(deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
                whitened = pa.array((y.astype(np.float64) / n @ projection).ravel())
                columns = [rows.column(0).take(pa.array(at)), times(np.arange(1, k + 1, dtype=np.int32)), times(np.full(k, n)), deviation, whitened, times(explained), times(np.full(k, error))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(id_col, vector_col).mapInArrow(run, schema)
