"""WARC archives: writing captures, reading them back, and assembling their transactions.

A page becomes three records: the request, the response (or a revisit of the capture that already holds an equal payload)
and metadata; request and metadata name the capture's record in WARC-Concurrent-To. Archives are gzipped text files of
records one after another, written by Spark with the record separator as line end, so any store that Spark writes will do; such a file is one
gzip member. Files are as many as the payloads' bytes ask for, and are read as streams, so that a task holds a file's compressed bytes and one record.
Reading follows Content-Length, recomputes the digests of responses, and joins the records of a capture through their concurrent-to
identifiers into one nested row; a response whose digest is wrong is marked, left out or raised, as the caller says.

Which page is the response is told from ids and digests alone. Payloads travel once, to the file of their id, so that no payload is a hot key.

A null page text is an empty payload. Payloads are equal when their bytes are; among equal ones of at least `min_bytes`
the one with the largest page id is the response. Rows that repeat both page id and payload are the same capture,
archived as often as they occur and counted in `n_copies`. Null ids and URLs are allowed; of equal payloads without any id each is
a response. Extra columns are ignored. An empty table gives an empty archive, and an empty table when read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payload bytes of a file, about, and records of one at most.
FILE_BYTES, RECORDS_PER_FILE = 32 << 20, 100_000
CRLF = "\r\n"
END_OF_RECORD = CRLF * 2
# The profile of revisit records in WARC 1.1, and the digits of base 32.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_DIGITS = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
# Fixed values end.


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1, from four groups of ten hexadecimal digits."""
    digest = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), *BASE32_DIGITS)


def _record(kind: str, fields: list[tuple[str, Column]], block: Column) -> Column:
    """The text of a record; fields that are null are left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), *(F.concat(F.lit(f"{name}: "), value) for name, value in fields), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def with_payload(pages: DataFrame) -> DataFrame:
    """Adds payload, payload_key and payload_bytes to pages (id, url, html)."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select("id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("payload_key"), F.octet_length(payload).cast("long").alias("payload_bytes"))


def originals(keyed: DataFrame, min_bytes: int) -> DataFrame:
    """(id, payload_key, original_id): of pages whose payload occurs more than once, the largest id among equal ones."""
    light = keyed.where(F.col("payload_bytes") >= min_bytes).select("id", "payload_key")
    equal = light.groupBy("payload_key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("original_id")).where("n > 1").drop("n")
    return light.distinct().join(equal, "payload_key").select("id", "payload_key", "original_id")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    keyed = with_payload(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(text_col).alias("html")))
    files = max(1, -(-keyed.agg(F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()[0] // FILE_BYTES))
    place = F.pmod(F.xxhash64("id", "payload_key"), F.lit(files * 64))  # several groups to a file, so that files are even
    of = originals(keyed, min_bytes).select(F.col("id").alias("of_id"), F.col("payload_key").alias("of_key"), "original_id", place.alias("of_place"))
    dealt = keyed.withColumn("place", place).repartition(files, "place")
    met = (F.col("place") == F.col("of_place")) & F.col("id").eqNullSafe(F.col("of_id")) & (F.col("payload_key") == F.col("of_key"))
    rows = dealt.join(of.repartition(files, "of_place").hint("shuffle_hash"), met, "left")
    name = lambda kind, number: F.concat(F.lit("<urn:capture:"), F.coalesce(number.cast("string"), F.lit("null")), F.lit(":"), F.substring("payload_key", 1, 32), F.lit(f":{kind}>"))
    revisits = F.col("original_id").isNotNull() & ~F.col("original_id").eqNullSafe(F.col("id"))
    capture, own = name("capture", F.col("id")), lambda kind: name(kind, F.col("id"))
    url = F.regexp_replace("url", r"[\r\n]+", " ")
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))
    shared = [("WARC-Target-URI", url), ("WARC-Date", F.lit(date))]
    about = [("WARC-Record-ID", capture), *shared, ("WARC-Payload-Digest", digest)]
    response = _record("response", [*about, ("Content-Type", F.lit("application/http;msgtype=response"))], F.concat(http, "payload"))
    revisit = _record("revisit", [*about, ("WARC-Refers-To", name("capture", F.col("original_id"))), ("WARC-Profile", F.lit(REVISIT_PROFILE)), ("Content-Type", F.lit("application/http;msgtype=response"))], http)
    request = _record("request", [("WARC-Record-ID", own("request")), ("WARC-Concurrent-To", capture), *shared, ("Content-Type", F.lit("application/http;msgtype=request"))], F.concat(F.lit("GET "), F.coalesce(url, F.lit("")), F.lit(f" HTTP/1.1{CRLF * 2}")))
    metadata = _record("metadata", [("WARC-Record-ID", own("metadata")), ("WARC-Concurrent-To", capture), *shared, ("Content-Type", F.lit("application/warc-fields"))], F.concat(F.lit("pageId: "), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(CRLF)))
    records = rows.select(F.explode(F.array(request, F.when(revisits, revisit).otherwise(response), metadata)).alias("value"))
    records.write.option("lineSep", END_OF_RECORD).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_records(stream: BinaryIO, ahead: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive, of which `ahead` bytes and a record are held; what is no record, or one that is cut off, raises ValueError."""
    held, at = b"", 0

    def more(least: int) -> bool:
        """Hold `least` bytes from `at` on, if the stream has them."""
        nonlocal held, at
        if len(held) - at < least:
            held, at = held[at:] + stream.read(max(ahead, least)), 0
        return len(held) - at >= least

    while more(1):
        if not (more(5) and held.startswith(b"WARC/", at)):
            raise ValueError("no WARC record where one should begin")
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more(len(held) - at + 1):
                raise ValueError("the head of a record is cut off")
        fields = dict(line.split(": ", 1) for line in held[at:end].decode("utf-8").split(CRLF)[1:])
        length = int(fields["Content-Length"])
        at = end + 4
        if not more(length):
            raise ValueError("the last record is cut off")
        block, at = held[at : at + length], at + length
        if more(len(END_OF_RECORD)) and not held.startswith(END_OF_RECORD.encode(), at):
            raise ValueError("a record is longer than it says")
        yield fields, block
        at = min(len(held), at + len(END_OF_RECORD))


#: Bytes of blocks that a task gives on at once, about.
BATCH_BYTES = 8 << 20
RECORD_FIELDS = (("record_id", "WARC-Record-ID"), ("record_type", "WARC-Type"), ("concurrent_to", "WARC-Concurrent-To"), ("target_uri", "WARC-Target-URI"), ("date", "WARC-Date"), ("payload_digest", "WARC-Payload-Digest"), ("refers_to", "WARC-Refers-To"))
RECORD_SCHEMA = ", ".join(f"{name} string" for name, _ in RECORD_FIELDS) + ", payload_bytes bigint, digest_ok boolean, block binary"


def _details(fields: dict[str, str], block: bytes) -> tuple[int | None, bool | None]:
    """Length of the full payload, and whether a response's payload has the digest that it should have."""
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None, None
    head, _, payload = block.partition(b"\r\n\r\n")
    if fields["WARC-Type"] == "response":
        return len(payload), "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode() == fields.get("WARC-Payload-Digest")
    lengths = [int(line.split(b":")[1]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    return (lengths[0] if lengths else None), None


def read_archive(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The records of all archives in a folder. blocks=False leaves the payload-bearing blocks of responses out."""

    schema = pa.schema([*((name, pa.string()) for name, _ in RECORD_FIELDS), ("payload_bytes", pa.int64()), ("digest_ok", pa.bool_()), ("block", pa.binary())])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                with gzip.open(io.BytesIO(content.as_buffer()), "rb") as stream:
                    for fields, block in parse_records(stream):
                        keep = blocks or fields["WARC-Type"] not in ("response", "revisit")
                        rows.append((*(fields.get(header) for _, header in RECORD_FIELDS), *_details(fields, block), block if keep else None))
                        held += len(block) if keep else 0
                        if len(rows) == 1000 or held > BATCH_BYTES:
                            yield table(rows)
                            rows, held = [], 0
                if rows:
                    yield table(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.where("length > 0").select("content").mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame, on_bad_digest: str = "keep") -> DataFrame:
    """One nested row for each capture: its response or revisit, its request and its metadata, and how often it is archived.

    A response whose payload hasn't the digest that its record names is kept, with digest_ok false, left out ("drop"), or an error ("raise").
    """
    if on_bad_digest not in ("keep", "drop", "raise"):
        raise ValueError("on_bad_digest is keep, drop or raise")
    by = F.coalesce("concurrent_to", "record_id").alias("capture_id")
    of = lambda *kinds: F.max(F.when(F.col("record_type").isin(*kinds), F.struct(*records.columns)))
    grouped = records.groupBy(by).agg(of("response", "revisit").alias("capture"), of("request").alias("request"), of("metadata").alias("metadata"), F.count_if(F.col("record_type").isin("response", "revisit")).alias("n_copies"))
    good = F.coalesce("capture.digest_ok", F.lit(True))
    wanted = F.lit(True) if on_bad_digest == "keep" else good if on_bad_digest == "drop" else F.when(good, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("wrong payload digest: "), "capture_id")).cast("boolean"))
    return grouped.where("n_copies > 0").where(wanted)
