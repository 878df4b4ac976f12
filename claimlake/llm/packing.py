"""Vector best-fit packing of tokenised documents into sequences.

Each piece of a document needs tokens, one place among a sequence's documents, and attention cost (the square of its
length, as tokens attend within their own document). A piece goes, longest first, into the open sequence that has room
under every capacity and either leaves the smallest weighted norm of residuals ("norm") or has the largest weighted dot
product of needs and residuals ("dot"). Pieces are dealt at random, by their row, into groups of about `group_pieces`, which are packed
independently: a group's loss is a sequence or two of thousands, and no task ever holds more than a group, however often a row repeats.

Null and empty texts consist of the end id alone. A text of any length is encoded whole and cut; a worker holds a slice of texts of
bounded bytes, or one longer text. Pieces of equal needs go by id and place. Repeated rows are packed as often as they occur. Extra
columns are ignored. An empty table gives an empty table. The ids are those of the tokenizer file with the vocabulary of the ranks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import codec
from .shared import materialise, parts

GROUP_PIECES = 10_000
END = (0).to_bytes(4, "little")


def cut(total: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: all of `most` tokens but the first, which may be shorter."""
    if total <= most:
        return [(0, total)]
    first = total % most
    return ([(0, first)] if first else []) + [(at, most) for at in range(first, total, most)]


def token_pieces(docs: DataFrame, ranks_path: str, pattern: str, max_tokens: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document, its ids followed by id 0."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 4 + with_ids]
        for batch in batches:
            for part in parts(batch):
                rows, of = [], []
                for row, text in enumerate(part.column("text")):
                    ids = own.encode(text.as_py()) + END
                    for piece, (start, length) in enumerate(cut(len(ids) // 4, max_tokens)):
                        of.append(row)
                        own_ids = ids[4 * start : 4 * (start + length)]
                        rows.append((piece, start, length, zlib.crc32(own_ids), own_ids)[: 4 + with_ids])
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(of, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["key", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    texts = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(run, schema)


def best_fit(needs: np.ndarray, capacities: np.ndarray, weights: np.ndarray, rule: str = "norm") -> np.ndarray:
    """The sequence of each piece. needs: a row for each piece; columns as in capacities and weights."""
    share = needs / capacities
    order = np.lexsort((np.arange(len(share)), -share[:, 0], -share.max(axis=1)))
    least = np.minimum.accumulate(share[order[::-1], 0])[::-1]  # the smallest of the pieces still to come
    residual, number = np.empty((1024, share.shape[1])), np.empty(1024, np.int64)
    opened = live = 0
    out = np.empty(len(share), np.int64)
    for step, item in enumerate(order):
        need = share[item]
        if step % 256 == 0 and live:  # sequences without room for any piece are closed
            keep = np.flatnonzero(residual[:live, 0] >= least[step] - 1e-12)
            residual[: len(keep)], number[: len(keep)], live = residual[keep], number[keep], len(keep)
        left = residual[:live] - need
        fits = np.flatnonzero((left >= -1e-12).all(axis=1))
        if len(fits):
            score = (left[fits] ** 2) @ weights if rule == "norm" else -(residual[fits] * need) @ weights
            at = fits[np.argmin(score)]
        else:
            if live == len(residual):
                residual, number = np.concatenate([residual, np.empty_like(residual)]), np.concatenate([number, np.empty_like(number)])
            at, live = live, live + 1
            residual[at], number[at], opened = 1.0, opened, opened + 1
        residual[at] -= need
        out[item] = number[at]
    return out


def pack(pieces: DataFrame, max_tokens: int, max_documents: int | None = None, max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3), rule: str = "norm", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces (key, piece, start, length, ...); capacities that are None never bind.

    Attention costs of a sequence add up to less than its tokens squared, so that their capacity binds only below the square of
    max_tokens, which pieces cut shorter than max_tokens allow.
    """
    capacities = np.array([max_tokens, max_documents or max_tokens, max_attention or max_tokens**2], float)
    if capacities[2] < 1 or rule not in ("norm", "dot"):
        raise ValueError("capacities must be positive, and the rule norm or dot")
    pieces = materialise(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "key", "piece", "start"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        length = group["length"].to_numpy(np.int64)
        needs = np.stack([length, np.ones_like(length), length**2], axis=1).astype(float)
        if len(length) and (needs.max(axis=0) > capacities).any():
            raise ValueError("a piece exceeds a capacity by itself")
        local = best_fit(needs, capacities, np.asarray(weights), rule)
        group["sequence_id"] = local + group["grp"].astype(np.int64) * 2**32
        group["offset"] = group.groupby("sequence_id")["length"].cumsum() - group["length"]
        return group.drop(columns="grp")

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    # by the row's place in the written table, which is the same in every attempt; so repeated rows don't meet in one group
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(run, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, max_tokens: int = 2048, id_col: str = "doc_id", text_col: str = "text", **capacities) -> DataFrame:
    """Tokenise into pieces and pack these."""
    return pack(token_pieces(docs, ranks_path, pattern, max_tokens, id_col, text_col), max_tokens, **capacities).withColumnRenamed("key", id_col)
