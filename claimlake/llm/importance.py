"""Importance resampling towards a target distribution of hashed n-grams.

Features of a text are all runs of 1 to `most_words` consecutive words, joined by one space, repeats counted. A feature's bucket is the unsigned crc32 of its UTF-8 bytes modulo
`buckets`. Per slice of a batch the bytes of equal features meet once: features are grouped by length into two-dimensional uint8 arrays, one row a distinct feature, the
crcs of all rows are updated column by column, and the buckets are scattered back to the features. Features longer than LONG bytes, most of whose lengths few share, form one ragged array
by falling length, of which a column updates the rows that are long enough.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, after lower-casing A-Z alone. A null text has no words, nor an empty one. Gains, weights and scores are
whole numbers: floors of a thousandfold, so that sums are exact whatever their order. Of the documents with enough words the highest scores are drawn, ties to the smaller id, null ids last.
Documents that share an id share their noise; repeated rows each take part. Without source or target rows all gains follow from the smoothing alone. Extra columns are ignored.

Texts are read twice, for counts and for weights. Counts are one number a bucket, which is what the driver gets; ranks come from a histogram of scores, whose number is bounded: gains lie within 44,000 of zero
and so does the noise, so that fewer than 200,000 scores exist.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise, parts

BUCKETS, LONG = 10_000, 64

#: Bytes of words, and A-Z lower-cased.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORD = np.zeros(256, bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[128:] = True


def crc_table(polynomial: int = 0xEDB88320) -> np.ndarray:
    """The reflected crc of each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(polynomial), table >> 1).astype(np.uint32)
    return table


_TABLE = crc_table()


def crc_columns(matrix: np.ndarray) -> np.ndarray:
    """crc32 of each row of a uint8 matrix, all rows at once, column by column."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = _TABLE[(crc.astype(np.uint8)) ^ column] ^ (crc >> 8)
    return ~crc


def crc_ragged(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of slices of data that come by falling length: column j updates those longer than j."""
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    longer = len(starts) - np.searchsorted(lengths[::-1], np.arange(int(lengths.max(initial=0))), "right")
    for j, n in enumerate(longer.tolist()):
        crc[:n] = _TABLE[crc[:n].astype(np.uint8) ^ data[starts[:n] + j]] ^ (crc[:n] >> 8)
    return ~crc


def distinct_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct rows of a uint8 matrix, where each row is among them); rows are compared as whole numbers of eight bytes."""
    n, length = matrix.shape
    padded = np.zeros((n, -(-length // 8) * 8), np.uint8)
    padded[:, :length] = matrix
    words = padded.view(np.uint64)
    if words.shape[1] == 1:
        found, at = np.unique(words[:, 0], return_inverse=True)
        return found.view(np.uint8).reshape(-1, 8)[:, :length], at
    order = np.lexsort(words.T)
    ordered = words[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    at = np.empty(n, np.int64)
    at[order] = np.cumsum(new) - 1
    return matrix[order[new]], at


def bucketed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each feature, a slice of data."""
    found = np.empty(len(starts), np.int64)
    by_length = np.argsort(lengths, kind="stable")
    ends = np.concatenate([np.flatnonzero(np.diff(lengths[by_length])) + 1, [len(lengths)]]) if len(lengths) else []
    begin = 0
    for end in ends:
        rows, length = by_length[begin:end], int(lengths[by_length[begin]])
        if length > LONG:
            break
        distinct, at = distinct_rows(data[starts[rows][:, None] + np.arange(length)])
        found[rows] = (crc_columns(distinct) % np.uint32(buckets))[at]
        begin = end
    rest = by_length[begin:][::-1]
    found[rest] = crc_ragged(data, starts[rest], lengths[rest]) % np.uint32(buckets)
    return found


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes of all texts, starts and ends of their words, number of words of each text)."""
    texts = texts.cast(pa.string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = _LOWER[raw]
    inside = np.concatenate([[False], _WORD[data], [False]])
    first = inside[1:] & ~inside[:-1]  # a word starts at i
    last = inside[:-1] & ~inside[1:]  # a word ends before i
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    edges = edges[inside[edges] & inside[edges + 1]]
    first[edges] = last[edges] = True  # words end with their text
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return data, starts, ends, np.diff(np.searchsorted(starts, offsets))


def features_of(texts: pa.Array, most_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its text, number of words of each text); the features of a run length follow one another."""
    data, starts, ends, n_words = words_of(texts)
    if most_words > 1:  # one space between words, so that runs of them are slices
        lengths = ends - starts
        moved = np.cumsum(lengths + 1) - lengths - 1
        spaced = np.full(int((lengths + 1).sum()), ord(" "), np.uint8)
        at = _ranges(starts, lengths)
        spaced[np.repeat(moved - starts, lengths) + at] = data[at]
        data, starts, ends = spaced, moved, moved + lengths
    text = np.repeat(np.arange(len(n_words)), n_words)
    found, owners = [], []
    for run in range(most_words):
        whole = text[run:] == text[: max(0, len(text) - run)]
        begin, end = starts[: len(whole)][whole], ends[run:][whole]
        found.append(bucketed(data, begin, end - begin, buckets))
        owners.append(text[: len(whole)][whole])
    return np.concatenate(found), np.concatenate(owners), n_words


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each slice, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def bucket_counts(rows: DataFrame, text_col: str, most_words: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in parts(batch, text_col):
                total += np.bincount(features_of(part.column(text_col), most_words, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for bucket, n in rows.select(text_col).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of each bucket, shares smoothed by one feature a bucket."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, most_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean of gains over the features of each text."""
    broadcast = docs.sparkSession.sparkContext.broadcast(gains)
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = broadcast.value
        for batch in batches:
            for part in parts(batch, text_col):
                found, owner, n_words = features_of(part.column(text_col), most_words, len(gains))
                n = np.bincount(owner, minlength=part.num_rows)
                total = np.zeros(part.num_rows, np.int64)
                np.add.at(total, owner, gains[found])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([part.column(id_col), *(pa.array(x, pa.int64()) for x in (n_words, n, weight))], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def noise(doc_id: Column, seed: str) -> Column:
    """Whole Gumbel noise of an id: floor(-1000 ln(-ln u)), u from the first 32 bits of sha256 of seed:id."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, most_words: int = 1, buckets: int = BUCKETS, seed: str = "2024", id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null for those not drawn.

    floor(percent * N / 100) of the N documents of at least `least_words` words are drawn: those of the highest sums of weight and noise, which is a sample without
    replacement in proportion to exp(weight / 1000).
    """
    gains = gains_of(bucket_counts(docs, text_col, most_words, buckets), bucket_counts(target, target_col, most_words, buckets))
    weighed = weights(docs, gains, most_words, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialise(weighed, "scores")
    may = F.col("n_words") >= least_words
    histogram = scored.where(may).groupBy("score").agg(F.count(F.lit(1)).alias("size"))
    # at most 200,000 scores exist, so one task may add them up and all may get them
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    higher = histogram.select("score", F.coalesce(F.sum("size").over(above), F.lit(0)).alias("higher"), (F.sum("size").over(Window.partitionBy()) * percent / 100).cast("long").alias("drawn"))
    reached = higher.where("higher < drawn")
    columns = ["doc_id", "n_features", "weight", "score"]
    met = scored.withColumn("may", may).join(F.broadcast(reached), "score", "left")
    candidate = F.col("may") & F.col("drawn").isNotNull()
    within = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    place = F.col("higher") + within
    ranked = met.where(candidate).select(*columns, F.when(place <= F.col("drawn"), place).alias("rank"))
    return ranked.unionByName(met.where(~candidate).select(*columns, F.lit(None).cast("long").alias("rank")))
