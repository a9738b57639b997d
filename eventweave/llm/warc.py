"""WARC archives: writing captures and assembling transactions (operator 4).

``write_archives`` writes, for every page, a request, a response or revisit, and a
metadata record (WARC/1.1); request and metadata point at the capture by
WARC-Concurrent-To.  Of the captures with equal payloads (of at least
``min_revisit_bytes`` bytes) the one with the largest page id is the response and
the others are revisits that carry headers only.  ``read_archives`` parses the files back
into one row a record.  ``transactions`` joins the records through their concurrent-to
identifiers into one nested row a capture.

Spark writes and reads the files, so they can be in any store Spark reaches: a record
ends with two CRLF, which is the line separator of the written lines.  An archive holds
a bounded number of records, so reading takes whole files.  Equal payloads meet
by a combined aggregation over their digests and a join back that Spark can split when one
payload fills many pages.

Edge cases: a null payload is empty; a null url gives an empty target URI, a null page id
sorts lowest and has no page header; rows that repeat the largest page id of a payload
are all responses; repeated rows are captures of their own; an empty table gives
empty archives and an empty result; other columns are ignored.  A capture without request or metadata has null
there; requests and metadata without a capture are left out (``unmatched`` lists them).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

#: records in one archive file
RECORDS = 4_000
CRLF = "\r\n"
#: fixed values of the format
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of binary ``payload``: 40 bits at a time."""
    digits = F.sha1(payload)
    part = lambda i: F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*[part(i) for i in range(4)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record(kind: Column, uri: Column, record_id: Column, extra: list[Column], content_type: str, block: Column) -> Column:
    """A record without its closing two CRLF; a null among ``extra`` is left out."""
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), record_id, F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        *extra,
        F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(CRLF + CRLF), block)


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, records: int = RECORDS) -> None:
    """Write ``pages(page_id, url, html)`` as gzip-compressed WARC files below ``path``."""
    payload = F.coalesce("html", F.lit(""))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    rows = pages.select("page_id", uri.alias("uri"), payload.alias("payload"), base32_sha1(payload.cast("binary")).alias("digest"))
    firsts = rows.filter(F.octet_length("payload") >= min_revisit_bytes).groupBy("digest").agg(F.max(F.struct("page_id", "uri")).alias("first"))
    firsts = materialize(firsts, "warc_first")  # a shuffle of its own for the join back, where a hot digest can be split
    known = rows.join(firsts, "digest", "left").withColumn("id", F.uuid()).withColumn("request_id", F.uuid()).withColumn("metadata_id", F.uuid())
    is_revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    bytes_ = F.octet_length("payload").cast("string")
    http = F.concat(
        F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])), bytes_, F.lit(CRLF + CRLF)
    )
    page = F.concat(F.lit("X-Page-ID: "), F.col("page_id").cast("string"))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    together = F.concat(F.lit("WARC-Concurrent-To: <urn:uuid:"), F.col("id"), F.lit(">"))
    response = _record(F.lit("response"), F.col("uri"), F.col("id"), [page, digest], "application/http; msgtype=response", F.concat(http, "payload"))
    refers = F.concat(F.lit("X-Refers-To-Page-ID: "), F.col("first.page_id").cast("string"))
    target = F.concat(F.lit("WARC-Refers-To-Target-URI: "), F.col("first.uri"))
    revisit = _record(
        F.lit("revisit"), F.col("uri"), F.col("id"),
        [page, digest, F.lit(f"WARC-Profile: {REVISIT_PROFILE}"), target, F.lit(f"WARC-Refers-To-Date: {DATE}"), refers],
        "application/http; msgtype=response", http,
    )
    host = F.regexp_extract("uri", r"://([^/?#]*)", 1)
    asked = F.regexp_replace("uri", r"^[^:]*://[^/?#]*|#.*$", "")
    ask = F.concat(F.lit("GET "), F.when(asked.startswith("/"), asked).otherwise(F.concat(F.lit("/"), asked)), F.lit(" HTTP/1.1" + CRLF + "Host: "), host, F.lit(CRLF + CRLF))
    request = _record(F.lit("request"), F.col("uri"), F.col("request_id"), [page, together], "application/http; msgtype=request", ask)
    notes = F.concat(F.lit("payloadBytes: "), bytes_, F.lit(CRLF))
    metadata = _record(F.lit("metadata"), F.col("uri"), F.col("metadata_id"), [page, together], "application/warc-fields", notes)
    written = known.select(F.explode(F.array(request, F.when(is_revisit, revisit).otherwise(response), metadata)).alias("value"))
    written.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", records).mode("overwrite").text(path)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record of an uncompressed archive."""
    at = 0
    while at < len(archive):
        border = archive.find(b"\r\n\r\n", at)
        if border < 0:
            raise ValueError(f"record header without end at byte {at}")
        version, *lines = archive[at:border].split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}: {version[:20]!r}")
        headers = {}
        for line in lines:
            name, _, value = line.partition(b":")
            headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
        length = int(headers["content-length"])
        block = archive[border + 4 : border + 4 + length]
        if len(block) != length or archive[border + 4 + length : border + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield headers, block
        at = border + 8 + length


_FIELDS = (
    ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("target_uri", pa.string()),
    ("page_id", pa.int64()), ("refers_to_page", pa.int64()), ("declared_digest", pa.string()), ("http_headers", pa.string()),
    ("fields", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
)
_SCHEMA = (
    "record_id string, record_type string, concurrent_to string, target_uri string, page_id long, refers_to_page long, "
    "declared_digest string, http_headers string, fields string, payload_bytes long, payload_digest string, payload binary"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row a record of the archives below ``path``.  Length and digest of a response's
    payload are taken from its bytes; ``with_payload=False`` leaves the bytes themselves out."""
    given = pa.schema(list(_FIELDS))

    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind = headers.get("warc-type")
        http, fields, payload, size, digest = None, None, None, None, None
        if headers.get("content-type", "").startswith("application/http"):
            top, _, body = block.partition(b"\r\n\r\n")
            http = top.decode("utf-8", "replace")
            if kind == "response":
                size, digest = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
                payload = body if with_payload else None
        elif kind == "metadata":
            fields = block.decode("utf-8", "replace")
        number = lambda name: int(headers[name]) if name in headers else None
        declared = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        return (
            headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-target-uri"), number("x-page-id"),
            number("x-refers-to-page-id"), declared, http, fields, size, digest, payload,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                raw = content.as_py()
                raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                rows, held = [], 0
                for headers, block in parse(raw):
                    rows.append(row(headers, block))
                    held += len(block)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), given, strict=True)], schema=given)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), given, strict=True)], schema=given)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    # one archive a row: small batches keep a task to a few archives at a time
    return files.select("content").mapInArrow(run, _SCHEMA)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row a capture: its own record, the request and the metadata whose
    concurrent-to identifier names it (the smallest record id if there are several)."""
    capture = records.filter(F.col("record_type").isin("response", "revisit")).select(
        "record_id", "record_type", "page_id", "target_uri", "refers_to_page", "declared_digest",
        F.struct("http_headers", "payload_bytes", "payload_digest", "payload").alias("response"),
    )
    side = records.filter(F.col("record_type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
    sides = side.groupBy("concurrent_to").agg(
        F.min(F.when(F.col("record_type") == "request", F.struct("record_id", "target_uri", "http_headers"))).alias("request"),
        F.min(F.when(F.col("record_type") == "metadata", F.struct("record_id", "fields"))).alias("metadata"),
    )
    joined = capture.join(sides, F.col("record_id") == F.col("concurrent_to"), "left").drop("concurrent_to")
    noted = F.regexp_extract("metadata.fields", r"payloadBytes: (\d+)", 1)
    return joined.withColumn("payload_bytes", F.coalesce("response.payload_bytes", F.when(noted != "", noted.cast("long")))).withColumn(
        "payload_digest", F.coalesce("response.payload_digest", "declared_digest")
    )


def unmatched(records: DataFrame) -> DataFrame:
    """Requests and metadata whose capture is not among ``records``."""
    captures = records.filter(F.col("record_type").isin("response", "revisit")).select(F.col("record_id").alias("capture"))
    side = records.filter(F.col("record_type").isin("request", "metadata"))
    return side.join(captures, F.col("concurrent_to") == F.col("capture"), "left_anti")


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives in the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/warc-{uuid.uuid4().hex[:8]}"
