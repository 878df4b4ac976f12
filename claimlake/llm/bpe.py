"""Byte-level BPE encoding and decoding by overlapping chunks.

A long text is dealt out as overlapping chunks, which are pre-tokenised in parallel. Neighbouring chunks are stitched at
the first boundary that both have in their overlap and that holds in any context (the end of a word or number, or the
start of white space), and the pieces between the stitches are encoded. Where an overlap has no such boundary, because
one run of characters is longer than it, the two chunks stay together as one segment. A text that fits one chunk is one segment.
Decoding concatenates the bytes of the ids.

Null and empty texts have no ids. Every row comes back with the ids of its own text, also rows with a null or a repeated id; of long texts,
rows that share id and text are encoded once and joined back. Columns of `docs` other
than the id and the text are ignored, so that their names can't clash. An empty table gives an empty table.
A worker holds one codec of the vocabulary and one slice of texts of bounded bytes at a time, and remembers nothing between them.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import parts

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 2_048
#: What a task can give of each text, beside its key: the ids and, from these, what decoding and digests need.
KINDS = {"ids": ("binary", pa.binary()), "n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded": ("binary", pa.binary())}


class Codec:
    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def encode(self, text: str) -> bytes:
        """ids as little-endian unsigned 32-bit numbers."""
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))

    def made_of(self, ids: bytes, what: str):
        if what == "ids":
            return ids
        if what == "n_tokens":
            return len(ids) // 4
        if what == "ids_sha256":
            return hashlib.sha256(",".join(map(str, memoryview(ids).cast("I"))).encode()).hexdigest()
        return self.decode(ids)

    def stitch_points(self, text: str) -> list[int]:
        """Ends of pieces that hold in any context: after a letter or number, or before white space."""
        points, last = [], len(text)
        for match in self.pattern.finditer(text):
            at = match.end()
            if at < last and not (before := text[at - 1]).isspace() and (text[at].isspace() or before.isalnum() and before.isalpha() != text[at].isalpha()):
                points.append(at)
        return points


@lru_cache(maxsize=1)
def codec(ranks_path: str, pattern: str) -> Codec:
    """One for each Python worker."""
    return Codec(ranks_path, pattern)


def _rows(ranks_path: str, pattern: str, keys: list[str], wanted: list[str], source: str = "text"):
    """Keys and the wanted columns of each row: its text is encoded (or its ids are taken), and all else is made from the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            for part in parts(batch, source):
                made = [[] for _ in wanted]
                for value in part.column(source):
                    ids = value.as_py() if source == "ids" else own.encode(value.as_py())
                    for column, what in zip(made, wanted, strict=True):
                        column.append(own.made_of(ids, what))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), *(pa.array(c, KINDS[w][1]) for c, w in zip(made, wanted, strict=True))], [*keys, *wanted])

    return run


def _fields(wanted: list[str]) -> str:
    return ", ".join(f"{w} {KINDS[w][0]}" for w in wanted)


def _points_of_chunks(ranks_path: str, pattern: str, stride: int, overlap: int):
    """Of each chunk the stitch points in its first and last `overlap` characters, counted from the start of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            for part in parts(batch):
                heads, tails = [], []
                for chunk, text in zip(part.column("chunk").to_pylist(), part.column("text").to_pylist(), strict=True):
                    points = own.stitch_points(text)
                    heads.append([chunk * stride + p for p in points if p <= overlap])
                    tails.append([chunk * stride + p for p in points if p >= stride])
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("chunk"), pa.array(heads, kind), pa.array(tails, kind)], ["key", "chunk", "head", "tail"])

    return run


def _segments(long: DataFrame, key_kind: str, ranks_path: str, pattern: str, chunk_chars: int, overlap_chars: int) -> DataFrame:
    """(key, segment, text): the stretches of each long text between its stitches."""
    span = chunk_chars + overlap_chars
    chunks = long.dropDuplicates(["key"]).select("key", F.explode(F.sequence(F.lit(0), F.expr(f"cast((length(text) - 1) div {chunk_chars} as int)"))).alias("chunk"), "text")
    chunks = chunks.select("key", "chunk", F.substring("text", F.col("chunk") * chunk_chars + 1, F.lit(span)).alias("text")).repartition("key", "chunk")
    points = chunks.mapInArrow(_points_of_chunks(ranks_path, pattern, chunk_chars, overlap_chars), f"key {key_kind}, chunk int, head array<int>, tail array<int>")
    in_order = Window.partitionBy("key").orderBy("chunk")
    cuts = points.select("key", "chunk", F.array_min(F.array_intersect("tail", F.lead("head").over(in_order))).alias("cut"), F.lead("chunk").over(in_order).isNull().alias("is_last"))
    cuts = cuts.select(
        "key", "chunk", "cut", "is_last",
        F.lag("cut").over(in_order).alias("begin"),
        F.count("cut").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("segment"),
    )
    offset = F.col("chunk") * chunk_chars
    begin = F.coalesce(F.col("begin") - offset, F.lit(0))
    end = F.when(F.col("is_last"), F.lit(span)).otherwise(F.coalesce(F.col("cut") - offset, F.lit(chunk_chars)))
    pieces = chunks.join(cuts, ["key", "chunk"]).select("key", "segment", "chunk", F.substring("text", begin + 1, end - begin).alias("text"))
    return pieces.groupBy("key", "segment").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda x: x["text"]), "").alias("text"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS, wanted: tuple[str, ...] = ("ids",)) -> DataFrame:
    """The id and the wanted columns of each text, in one pass.

    ids are little-endian unsigned 32-bit numbers; n_tokens counts them, ids_sha256 is taken over them as decimals joined by
    commas, and decoded is their concatenated bytes.
    """
    if not 0 < overlap_chars <= chunk_chars:
        raise ValueError("the overlap must be positive and no longer than a chunk")
    wanted = list(wanted)
    texts = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = texts.schema["key"].dataType.simpleString()
    fits = F.length("text") <= chunk_chars + overlap_chars
    short = texts.where(fits).mapInArrow(_rows(ranks_path, pattern, ["key"], wanted), f"key {kind}, {_fields(wanted)}")

    # equal structs may hold nulls, so that rows without an id find their ids as well
    long = texts.where(~fits).select(F.struct("key", F.sha2("text", 256).alias("digest")).alias("key"), "text")
    long_kind = f"struct<key:{kind},digest:string>"
    segments = _segments(long, long_kind, ranks_path, pattern, chunk_chars, overlap_chars)
    encoded = segments.mapInArrow(_rows(ranks_path, pattern, ["key", "segment"], ["ids"]), f"key {long_kind}, segment bigint, ids binary")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "ids"))), lambda x: F.hex(x["ids"])), "")
    whole = encoded.groupBy("key").agg(F.unhex(joined).alias("ids"))
    whole = long.select("key").join(whole, "key").select("key.key", "ids").mapInArrow(_rows(ranks_path, pattern, ["key"], wanted, "ids"), f"key {kind}, {_fields(wanted)}")
    return short.unionByName(whole).withColumnRenamed("key", id_col)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", wanted: tuple[str, ...] = ("n_tokens", "ids_sha256", "decoded")) -> DataFrame:
    """The id and the wanted columns of rows (id, ids)."""
    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("key"), "ids")
    return rows.mapInArrow(_rows(ranks_path, pattern, ["key"], list(wanted), "ids"), f"key {kind}, {_fields(list(wanted))}").withColumnRenamed("key", id_col)
