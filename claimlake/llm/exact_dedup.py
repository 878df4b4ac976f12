"""Exact deduplication with counting quotient filters.

Every partition puts the 64-bit fingerprints of its normalised texts into counting quotient filters, one for each block of
fingerprints with the same leading bits. A filter has as many quotients as it has entries, so its bytes follow the entries; with its own number of
quotient bits, quotient and remainder still are the whole fingerprint, and the filters of a block merge without loss, as
each keeps its remainders sorted. The merged filters give the fingerprints that occur more than once. Only texts with such a fingerprint
are shuffled, and grouped by their bytes. Texts that differ but share a fingerprint are thereby told apart.

Null counts as the empty text, and all empty texts are equal. In copies(), rows that repeat both id and text of the row that stays
count in group_size and carry its mark: there an id names one row. A row without an id stays only if no row of its text has one, and then all of these carry the mark. deduplicate() keeps exactly one row of equal texts, whatever the ids:
that of the smallest id, nulls last. Extra columns are kept by deduplicate(), whatever their names. An empty table gives an empty table.
Texts of any length are fingerprinted whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import left_join_large, materialise, maybe_member

#: Distinct fingerprints that a block of the merged filters has about, and those after which a partition sends its filters on.
BLOCK_ENTRIES, HELD_ENTRIES = 1 << 18, 1 << 21


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; single spaces are left alone, which saves rewriting them."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*", " ")


class QuotientFilter:
    """A counting quotient filter of the fingerprints of a block, without empty slots between its runs.

    The leading `bits` bits after those of the block are the quotient, the rest the remainder. occupied has a bit for each quotient,
    run_end one for each slot; the remainders of a quotient are a sorted run. Slots that count more than one are listed with their counts.
    """

    def __init__(self, bits: int, occupied: np.ndarray, run_end: np.ndarray, remainders: np.ndarray, counted: np.ndarray, counts: np.ndarray):
        self.bits, self.occupied, self.run_end, self.remainders, self.counted, self.counts = bits, occupied, run_end, remainders, counted, counts

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray, block_bits: int) -> QuotientFilter:
        """From sorted distinct fingerprints of one block."""
        bits = min(max(3, int(len(fingerprints) - 1).bit_length()), 63 - block_bits)
        inner = fingerprints << np.uint64(block_bits)
        quotients = inner >> np.uint64(64 - bits)
        occupied = np.zeros(1 << bits, bool)
        occupied[quotients] = True
        counted = np.flatnonzero(counts > 1)
        return cls(bits, np.packbits(occupied), np.packbits(np.r_[quotients[1:] != quotients[:-1], True]), inner << np.uint64(bits) >> np.uint64(bits), counted.astype(np.uint32), counts[counted].astype(np.int64))

    def entries(self, block: int, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted fingerprints and their counts."""
        quotients = np.flatnonzero(np.unpackbits(self.occupied)).astype(np.uint64)
        ends = np.flatnonzero(np.unpackbits(self.run_end, count=len(self.remainders)))
        inner = np.repeat(quotients, np.diff(np.r_[-1, ends])) << np.uint64(64 - self.bits) | self.remainders
        counts = np.ones(len(inner), np.int64)
        counts[self.counted] = self.counts
        head = np.uint64(block << (64 - block_bits)) if block_bits else np.uint64(0)
        return inner >> np.uint64(block_bits) | head, counts

    @classmethod
    def merged(cls, filters: list[QuotientFilter], block: int, block_bits: int) -> QuotientFilter:
        """Runs merge by sorted remainders; equal fingerprints add their counts."""
        fingerprints, counts = (np.concatenate(x) for x in zip(*(f.entries(block, block_bits) for f in filters), strict=True))
        order = np.argsort(fingerprints, kind="stable")
        fingerprints, counts = fingerprints[order], counts[order]
        first = np.flatnonzero(np.r_[True, fingerprints[1:] != fingerprints[:-1]])
        return cls.of(fingerprints[first], np.add.reduceat(counts, first), block_bits)

    def row(self) -> tuple[int, bytes, bytes, bytes, bytes, bytes]:
        return (self.bits, *(x.tobytes() for x in (self.occupied, self.run_end, self.remainders, self.counted, self.counts)))

    @classmethod
    def from_row(cls, bits: int, *columns: bytes) -> QuotientFilter:
        return cls(bits, *(np.frombuffer(c, k) for c, k in zip(columns, (np.uint8, np.uint8, np.uint64, np.uint32, np.int64), strict=True)))


FILTER_COLUMNS = ("bits", "occupied", "run_end", "remainders", "counted", "counts")
FILTER_SCHEMA = "block bigint, bits int, occupied binary, run_end binary, remainders binary, counted binary, counts binary"


def _filters_of(fingerprints: np.ndarray, block_bits: int, rows_at_once: int = 1024) -> Iterator[pa.RecordBatch]:
    fingerprints, counts = np.unique(fingerprints, return_counts=True)
    blocks = (fingerprints >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(fingerprints), np.int64)
    begin = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
    for at in range(0, len(begin), rows_at_once):
        rows = []
        for low, high in zip(begin[at : at + rows_at_once], np.r_[begin, len(blocks)][at + 1 : at + 1 + rows_at_once], strict=True):
            rows.append((int(blocks[low]), *QuotientFilter.of(fingerprints[low:high], counts[low:high], block_bits).row()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["block", *FILTER_COLUMNS])


def partition_filters(fingerprints: DataFrame, block_bits: int) -> DataFrame:
    """The filters of each partition of a table of fingerprints (fp), by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            n += batch.num_rows
            if n >= HELD_ENTRIES:
                yield from _filters_of(np.concatenate(held), block_bits)
                held, n = [], 0
        if n:
            yield from _filters_of(np.concatenate(held), block_bits)

    return fingerprints.select("fp").mapInArrow(run, FILTER_SCHEMA)


def repeated(filters: DataFrame, block_bits: int) -> DataFrame:
    """(fp, n) of the fingerprints that the merged filters count more than once."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        block = key[0].as_py()
        own = [QuotientFilter.from_row(*row) for row in zip(*(group.column(c).to_pylist() for c in FILTER_COLUMNS), strict=True)]
        fp, counts = QuotientFilter.merged(own, block, block_bits).entries(block, block_bits)
        return pa.table({"fp": pa.array(fp[counts > 1].view(np.int64)), "n": pa.array(counts[counts > 1])})

    return filters.groupBy("block").applyInArrow(run, "fp bigint, n bigint")


def twice_seen(fingerprints: DataFrame) -> DataFrame:
    """(fp, n) of the fingerprints (fp) that a written table holds more than once."""
    block_bits = max(0, (fingerprints.count() // BLOCK_ENTRIES).bit_length())
    return materialise(repeated(partition_filters(fingerprints, block_bits), block_bits), "repeated")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row."""
    texts = docs.select(F.col(id_col).alias("key"), normalised(F.col(text_col)).alias("norm"))
    texts = texts.withColumn("fp", F.xxhash64("norm"))
    rows = materialise(texts.select("key", "fp", F.sha2("norm", 256).alias("text_sha256")), "digests")
    twice = twice_seen(rows)
    # copies meet within their tasks before they are dealt by text, so that a large group sends a row a task
    suspects = maybe_member(texts, "fp", twice, twice.count())[0]
    groups = suspects.groupBy("fp", "norm").agg(F.min("key").alias("keep_id"), F.count(F.lit(1)).alias("size")).where("size > 1")
    groups = materialise(groups.select("fp", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "size"), "groups")
    out = left_join_large(rows, groups, ["fp", "text_sha256"], rows.count()).withColumnRenamed("size", "group_size")
    keep = F.coalesce("keep_id", "key")
    return out.select(F.col("key").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), keep.eqNullSafe(F.col("key")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs of each text, by rows, not ids; texts that occur once never leave their partition."""
    norm = normalised(F.col(text_col))
    twice = twice_seen(materialise(docs.select(F.xxhash64(norm).alias("fp")), "fingerprints"))
    rows = docs.select(F.struct("*").alias("row"), F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(text_col)).alias("place"), norm.alias("norm"), F.xxhash64(norm).alias("fp"))
    maybe, alone = maybe_member(rows, "fp", twice, twice.count())
    # rows that only seemed to be repeated are groups of one
    found = maybe.groupBy("fp", "norm").agg(F.min_by("row", "place").alias("row")).select("row.*")
    return found if alone is None else found.unionByName(alone.select("row.*"))
