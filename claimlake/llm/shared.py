"""Joins that deal large groups over all tasks, slices of Arrow batches, and a bounded membership filter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import delete, materialise, scratch, shared_dir
from ..sources.shared import scratch_path as fresh_path

__all__ = ["LARGE_SHARES", "bitmap_words", "delete", "fresh_path", "join_large", "left_join_large", "materialise", "maybe_member", "parts", "scratch", "shared_dir"]

#: Groups of more than one such share of all rows are joined by broadcast; there are fewer of them than this.
LARGE_SHARES = 1024


def join_large(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Inner join of rows to their groups, a row of `groups` each, so that no large group lands in one task.

    groups has the number of its rows as column size, and total is the number of all rows or more: fewer than LARGE_SHARES groups can hold a larger
    share than that, so these are broadcast whatever the input; all others meet their rows by a shuffle. Rows with a null key meet none.
    """
    large = F.col("size") * LARGE_SHARES > total
    hot, usual = F.broadcast(groups.where(large)), groups.where(~large)
    rest = rows.join(F.broadcast(groups.where(large).select(keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(usual, keys))


def left_join_large(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """As join_large, but rows that meet no group stay, with nulls."""
    large = F.col("size") * LARGE_SHARES > total
    met = rows.join(F.broadcast(groups.where(large)), keys, "left")
    rest = met.where("size is null").select(rows.columns).join(groups.where(~large), keys, "left")
    return met.where("size is not null").unionByName(rest)


def parts(batch: pa.RecordBatch, column: str = "text", most_bytes: int = 1 << 21, most_rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about `most_bytes` together, so that memory follows bytes, not rows; one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = min(begin + most_rows, max(begin + 1, int(np.searchsorted(ends, before + most_bytes, "right"))))
        yield batch.slice(begin, end - begin)
        begin = end


#: Bits that a bitmap has for each member, and the words of 64 bits that it has at most: 2**20, about 50 MB once broadcast.
BITS_A_MEMBER, MOST_BITMAP_WORDS = 16, 1 << 20


def bitmap_words(members: int) -> int | None:
    """Words of a bitmap for so many members; None if it would not shut out enough within its bound."""
    words = 1 << max(8, (members * BITS_A_MEMBER // 64).bit_length())
    return words if words <= 4 * MOST_BITMAP_WORDS else None


def _bit(hashed: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function("shiftrightunsigned", hashed, F.lit(40)).cast("int") % 64)


def maybe_member(df: DataFrame, key: str, members: DataFrame, count: int) -> tuple[DataFrame, DataFrame | None]:
    """(maybe, surely_not): rows whose key may be among the members, all real ones and few others, and the rest.

    An exact join of the first part has to follow. The members' hashed bitmap has at most MOST_BITMAP_WORDS rows and is broadcast; where
    it would hold too many members to tell anything, every row is a maybe and there is no rest.
    """
    words = bitmap_words(count)
    if words is None:
        return df, None
    words = min(words, MOST_BITMAP_WORDS)
    hashed = F.xxhash64(key)
    bits = members.select(F.pmod(hashed, F.lit(words)).alias("__word"), _bit(hashed).alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    met = df.withColumn("__hash", hashed).join(F.broadcast(bits), F.pmod("__hash", F.lit(words)) == F.col("__word"), "left")
    hit = F.coalesce(F.col("__bits").bitwiseAND(_bit(F.col("__hash"))) != 0, F.lit(False))
    return met.where(hit).select(df.columns), met.where(~hit).select(df.columns)
