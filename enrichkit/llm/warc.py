"""Operator 9, WARC archives: write, read back, assemble transactions.

Writing: every page gets a request, a response (or revisit) and a metadata
record, tied together by WARC-Concurrent-To. Of pages with equal payloads of
at least ``min_bytes`` bytes the one with the largest id is the response and
the others are revisits that refer to it. Only ids and digests meet in that
choice (a map-side combined maximum by SHA-1, SHA-256 and length). A WARC record ends with two
line ends, so Spark's own text writer, with that as its line separator,
writes valid archives to any file system Spark reaches, with its commit
protocol; a retried task leaves no partial archive.

Reading: archives are read whole as binary files (their number of records is
bounded when they are written) and parsed one after the other by
Content-Length, so payloads may hold anything, also what looks like a record.

Assembly: request, response or revisit, and metadata records are joined
through their concurrent-to identifiers (a record may name several, and either
side of a pair may name the other), and revisits with the response that they
refer to; one nested row per capture comes out, with all its request and
metadata records as arrays. A capture with more than ``AT_ONCE`` of them gives
further rows (``part`` 1, 2, ...), so no array grows with the data. Request and
metadata records that no capture is tied to are ``unassembled``. A response
refers to itself in the join, so there are no null keys; the copies of one hot
page are split by Spark's skew join (with adaptive execution off they are one
task).

A response whose payload does not match its declared digest is flagged
(``digest_ok`` false); ``payload_digest`` is that of the payload found.

Defined cases: a null html is an empty payload; a null url is written
without a target, a null id as an empty field and read back as null. Control
characters and spaces of a url are percent-encoded. Of equal rows one is the
response. An empty table writes no record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import as_literal_path, col, written

EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, content_type string, "
    "payload_digest string, declared_digest string, payload_bytes long, digest_ok boolean, http_head string, payload binary, "
    "page_id string"
)
#: Request or metadata records of a capture in one row.
AT_ONCE = 10_000


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: each five hex digits are four base32 digits."""
    digits = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(text: Column) -> Column:
    h = F.md5(text.cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record(kind: str, record_id: Column, date: str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without the two line ends after it; null headers are left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {date}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(EOL, *lines), F.lit(EOL + EOL), block)


def write_archives(
    spark: SparkSession,
    pages_path: str,
    out: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    max_records: int = 30_000,
) -> None:
    """Write the parquet table at ``pages_path`` as gzipped WARC files under ``out``."""
    source = spark.read.parquet(as_literal_path(pages_path))
    place = source.metadataColumn("_metadata")  # also beside a column of that name
    where = F.concat_ws(":", place["file_path"], place["row_index"].cast("string"))
    rows = source.select(
        col(id_col).alias("page_id"),
        col(url_col).cast("string").alias("url"),
        F.coalesce(col(html_col).cast("string"), F.lit("")).alias("html"),
        F.md5(where.cast("binary")).alias("uid"),
    )
    slim = rows.select(
        "uid", "page_id", base32_sha1(F.col("html").cast("binary")).alias("digest"),
        F.unhex(F.sha2(F.col("html").cast("binary"), 256)).alias("strong"), F.octet_length("html").alias("bytes"),
    )
    keeper = (
        slim.filter(F.col("bytes") >= min_bytes)
        .groupBy(F.col("digest").alias("d"), F.col("strong").alias("s"), F.col("bytes").alias("b"))
        .agg(F.max(F.struct("page_id", "uid")).alias("first"))
    )
    same = (F.col("digest") == F.col("d")) & (F.col("strong") == F.col("s")) & (F.col("bytes") == F.col("b"))
    chosen = slim.join(keeper, same, "left").select(
        F.col("uid").alias("of"), "digest", F.when(F.col("first.uid") != F.col("uid"), F.col("first.uid")).alias("original")
    )
    pages = rows.join(chosen, F.col("uid") == F.col("of"))

    response = _uuid(F.col("uid"))
    uri = F.col("url")
    for code in (0, 9, 10, 13, 32, 127):
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    head = F.concat(
        F.lit(EOL.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
        F.octet_length("html").cast("string"),
        F.lit(EOL + EOL),
    )
    http = F.lit("application/http; msgtype=response")
    common = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest), ("Content-Type", http)]
    full = _record("response", response, date, common, F.concat(head, F.col("html")))
    revisit = _record(
        "revisit",
        response,
        date,
        [("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", _uuid(F.col("original"))), *common],
        head,
    )
    request = _record(
        "request",
        _uuid(F.concat("uid", F.lit("request"))),
        date,
        [("WARC-Concurrent-To", response), ("WARC-Target-URI", uri), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(f" HTTP/1.1{EOL}{EOL}")),
    )
    metadata = _record(
        "metadata",
        _uuid(F.concat("uid", F.lit("metadata"))),
        date,
        [("WARC-Concurrent-To", response), ("WARC-Target-URI", uri), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(EOL)),
    )
    records = pages.select(
        F.explode(F.array(request, F.when(F.col("original").isNull(), full).otherwise(revisit), metadata)).alias("value")
    )
    (
        records.write.option("lineSep", EOL + EOL)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_records)
        .text(out)
    )


def parse_records(stream) -> Iterator[tuple[dict, bytes]]:
    """(headers with lower-case names, block) of every record of one archive; WARC-Concurrent-To is a list."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        headers: dict = {"warc-concurrent-to": []}
        while (line := stream.readline().strip(b"\r\n")):
            name, _, value = line.partition(b":")
            name, value = (x.decode("utf-8", "replace").strip() for x in (name, value))
            if name.lower() == "warc-concurrent-to":
                headers["warc-concurrent-to"].append(value)
            else:
                headers[name.lower()] = value
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends within a record")
        yield headers, block


def _row(headers: dict, block: bytes) -> tuple:
    kind = headers.get("warc-type")
    declared = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    digest = declared
    head = payload = page_id = n = ok = None
    if kind in ("request", "response", "revisit"):
        first, _, payload = block.partition(b"\r\n\r\n")
        head = first.decode("utf-8", "replace")
    if kind == "response":
        n = len(payload)
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        # digests by other algorithms cannot be checked here
        ok = declared is None or ":" in declared or declared.upper() == found
        digest = found
    elif kind == "metadata":
        for line in block.decode("utf-8", "replace").split("\r\n"):
            name, _, value = line.partition(":")
            if name.strip().lower() == "page-id":
                page_id = value.strip() or None
    return (
        kind, headers.get("warc-record-id"), headers["warc-concurrent-to"], headers.get("warc-refers-to"),
        headers.get("warc-target-uri"), headers.get("content-type"), digest, declared, n, ok, head, payload, page_id,
    )


def read_records(spark: SparkSession, path: str, *, batch_bytes: int = 16 << 20) -> DataFrame:
    """One row per WARC record of the (gzipped or plain) archives under ``path``."""
    names, types = zip(*(f.split() for f in RECORD.split(", ")), strict=True)
    of = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    kinds = [of[t] for t in types]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_buffer()
                stream = io.BufferedReader(pa.BufferReader(data)) if data.size else io.BytesIO()
                if stream.peek(2)[:2] == b"\x1f\x8b" if data.size else False:
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
                for headers, block in parse_records(stream):
                    rows.append(_row(headers, block))
                    size += len(block) + 500
                    if size >= batch_bytes:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def _links(records: DataFrame) -> DataFrame:
    """(side_id, capture_id) of every request or metadata record and a capture that it is tied to, by either's header."""
    own = F.col("type").isin("response", "revisit")
    named = records.select("record_id", own.alias("own"), F.explode("concurrent_to").alias("other"))
    return named.select(
        F.when(F.col("own"), F.col("other")).otherwise(F.col("record_id")).alias("side_id"),
        F.when(F.col("own"), F.col("record_id")).otherwise(F.col("other")).alias("capture_id"),
    ).distinct()


def _sides(records: DataFrame, links: DataFrame, kind: str, *cols: str) -> DataFrame:
    """of, part and the array of the ``kind`` records that are tied to capture ``of``."""
    side = records.filter(F.col("type") == kind).select("record_id", *cols)
    tied = links.join(side, F.col("side_id") == F.col("record_id")).select(
        F.col("capture_id").alias("of"), F.struct("record_id", *cols).alias("r")
    )
    many = tied.groupBy("of").count().filter(F.col("count") > AT_ONCE)
    many = many.select(F.col("of").alias("many_of"), F.ceil(F.col("count") * 2 / AT_ONCE).alias("parts"))
    parts = tied.join(many, F.col("of") == F.col("many_of"), "left")
    part = F.coalesce(F.pmod(F.xxhash64("r.record_id"), F.col("parts")), F.lit(0)).cast("int").alias("part")
    return parts.groupBy("of", part).agg(F.sort_array(F.collect_list("r")).alias(kind))


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture, requests, metadata and original.

    ``request`` and ``metadata`` are arrays of all records tied to the capture,
    by record id; ``original`` is the response that holds the payload: the
    capture itself or, for a revisit, the one that it refers to. ``part`` is 0
    but for further rows of a capture with very many records.
    """
    own = records.filter(F.col("type").isin("response", "revisit"))
    capture = own.select(
        F.col("record_id").alias("key"),
        F.coalesce("refers_to", "record_id").alias("original_key"),
        F.struct(
            "type", "record_id", "target_uri", "payload_digest", "declared_digest", "payload_bytes", "digest_ok", "http_head", "payload"
        ).alias("capture"),
    )
    # everything but the payloads is written once: an archive is parsed twice, not once for each join
    records = written(records.drop("payload", "payload_digest", "declared_digest", "content_type"), "warc-records")
    links = _links(records)
    request = _sides(records, links, "request", "target_uri", "http_head")
    metadata = _sides(records, links, "metadata", "page_id")
    sides = request.withColumnsRenamed({"of": "of_r", "part": "part_r"}).join(
        metadata, (F.col("of_r") == F.col("of")) & (F.col("part_r") == F.col("part")), "full"
    ).select(F.coalesce("of_r", "of").alias("of"), F.coalesce("part_r", "part").alias("part"), "request", "metadata")
    tied = capture.join(sides, F.col("key") == F.col("of"), "left")
    held = records.filter(F.col("type") == "response").select(F.col("record_id").alias("id"), "payload_bytes")
    # the page that the least metadata record names
    page = records.filter(F.col("type") == "metadata").join(links, F.col("record_id") == F.col("side_id"))
    page = page.groupBy("capture_id").agg(F.min(F.struct("record_id", "page_id"))["page_id"].alias("page_id"))
    original = held.join(page, F.col("id") == F.col("capture_id"), "left").select(
        F.col("id").alias("held_id"), F.struct("id", "page_id", "payload_bytes").alias("original")
    )
    none = lambda c: F.coalesce(c, F.array().cast(tied.schema[c].dataType)).alias(c)
    return tied.join(original, F.col("original_key") == F.col("held_id"), "left").select(
        "capture", none("request"), none("metadata"), "original", F.coalesce("part", F.lit(0)).alias("part")
    )


def unassembled(records: DataFrame) -> DataFrame:
    """The request and metadata records that no capture of ``records`` is tied to."""
    own = records.filter(F.col("type").isin("response", "revisit")).select(F.col("record_id").alias("own_id"))
    tied = _links(records).join(own, F.col("capture_id") == F.col("own_id"), "left_semi")
    sides = records.filter(F.col("type").isin("request", "metadata"))
    return sides.join(tied, F.col("record_id") == F.col("side_id"), "left_anti")
