"""Content-addressed WARC archive.

An archive is two tables: ``payloads`` holds every distinct payload once under
its SHA-256, checked while it is built (all payloads with one digest must have one
length, MD5 and 64-bit hash as well), and ``records`` holds the exact WARC and HTTP headers of every
record with the digest of its payload.  Joining the two gives the original
records back byte by byte.

``write_warc`` turns an archive into WARC/1.1 files with Spark's text writer,
whose line separator is the blank line pair that ends a record.  Records whose
payload another record holds become revisit records.  ``read_warc`` reads such
files, record by record by Content-Length, verifies every response's digest
again, and that every revisit has the length and digest of the response that it
refers to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import batches_of, rows_of, store

#: payloads of at least so many bytes are stored once and revisited
LEAST_BYTES = 0
#: records in one file, of payloads up to ``LARGE`` bytes and of larger ones; bounds a file's bytes
FILE_RECORDS = 2000
LARGE_RECORDS = 32
LARGE = 128 << 10
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_END = "\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits give four characters."""
    hexed = F.sha1(payload)
    chars = []
    for group in range(8):
        bits = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            chars.append(F.substring(F.lit(ALPHABET), at, F.lit(1)))
    return F.concat(*chars)


def build_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  least_bytes: int = LEAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(records, payloads)`` of the rows of ``pages``, both stored.

    A null payload counts as empty.  Of equal payloads with at least
    ``least_bytes`` bytes the row with the smallest id is the response (null
    ids last, then the first row); the others revisit it.  Rows that repeat a
    page id are records of their own, told apart by their row, so a revisit can
    refer to a record of its own page id.  Line breaks in a url are
    percent-encoded, a null url leaves its header out.  An empty table gives an
    empty archive.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    digested = source.select("page_id", "url", "payload", F.sha2("payload", 256).alias("digest"))
    plain = store(digested.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url", "digest",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest")), "warc-rows")
    check = F.struct(F.octet_length("payload").alias("n"), F.md5("payload").alias("m"), F.xxhash64("payload").alias("x"))
    once = digested.groupBy("digest").agg(F.min("payload").alias("payload"), F.min(check).alias("least"),
                                          F.max(check).alias("most"))
    payloads = store(once.select("digest", F.when(F.col("least") == F.col("most"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads with digest "), "digest"))).alias("payload")), "warc-payloads")
    first = plain.groupBy("digest").agg(F.min(F.struct(
        F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("first"))
    kind = (F.col("row") == F.col("first.row")) | (F.col("payload_bytes") < least_bytes)
    typed = plain.join(first, "digest").select(
        "row", "page_id", "url", "digest", "payload_bytes", "payload_digest",
        F.when(kind, "response").otherwise("revisit").alias("record_type"),
        F.when(~kind, F.struct("first.page_id", "first.row")).alias("target"))
    records = store(typed.select("*", http_header(F.col("payload_bytes")).alias("http_header"))
                    .select("*", warc_header().alias("warc_header"))
                    .drop("url", "target", "payload_bytes", "payload_digest"), "warc-records")
    return records, payloads


def _urn(page: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"),
                    row.cast("string"), F.lit(">"))


def http_header(size: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    size.cast("string"), F.lit("\r\n\r\n"))


def warc_header() -> Column:
    """The exact header block of a record, from the columns of ``build_archive``."""
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    revisit = F.col("record_type") == "revisit"
    body = F.octet_length("http_header") + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"),
             F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("page_id"), F.col("row"))),
             F.lit(f"WARC-Date: {DATE}"),
             F.concat(F.lit("WARC-Target-URI: "), url),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("target.page_id"), F.col("target.row")))),
             F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), body.cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))  # concat_ws leaves nulls out


def reconstruct(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """``row, page_id, record_type, warc_header, http_header, payload`` of every original record."""
    return records.join(payloads, "digest").select(
        "row", "page_id", "record_type", "warc_header", "http_header", "payload")


def write_warc(records: DataFrame, payloads: DataFrame) -> str:
    """Write the archive as gzip-compressed WARC files; returns the folder."""
    path = shared_path(records.sparkSession, "llm", f"warc-{uuid.uuid4().hex}")
    revisits = records.where("record_type = 'revisit'").select(F.concat("warc_header", "http_header").alias("value"))
    for folder, size, limit in (("records", F.octet_length("payload") <= LARGE, FILE_RECORDS),
                                ("large", F.octet_length("payload") > LARGE, LARGE_RECORDS)):
        lines = records.where("record_type = 'response'").join(payloads.where(size), "digest").select(
            F.concat("warc_header", "http_header", "payload").alias("value"))
        (lines.union(revisits) if folder == "records" else lines).write.option("lineSep", RECORD_END).option(
            "compression", "gzip").option("maxRecordsPerFile", limit).text(f"{path}/{folder}")
    return path


def parse_warc(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of every record of a binary stream."""
    while line := data.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := data.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = data.read(int(headers["content-length"]))
        if data.read(4) != RECORD_END.encode():
            raise ValueError("a record does not end where its length says")
        yield headers, block


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                   ("record_id", pa.string()), ("target_id", pa.string())])


def _page_of(urn: str | None) -> int | None:
    name = urn.strip("<>").split(":")[2] if urn else "none"
    return None if name == "none" else int(name)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for (content,) in rows_of(batches):
            # unpacked as it is read, one record in memory at a time
            for headers, block in parse_warc(gzip.GzipFile(fileobj=io.BytesIO(content))):
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                if headers["warc-type"] == "response" and (
                        len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
                yield (_page_of(headers["warc-record-id"]), size, digest, headers["warc-type"],
                       _page_of(headers.get("warc-refers-to")), headers.get("warc-target-uri"),
                       headers["warc-record-id"], headers.get("warc-refers-to"))
    return batches_of(rows(), _READ)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url`` of every record, verified."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option(
        "recursiveFileLookup", "true").load(path).select("content")
    rows = store(files.mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                         "refers_to long, url string, record_id string, target_id string"), "warc-read")
    # one row for all revisits of a response that say the same
    revisits = (rows.where("record_type = 'revisit'").groupBy("target_id", "payload_bytes", "payload_digest")
                .agg(F.min("record_id").alias("record_id")))
    responses = rows.where("record_type = 'response'").select(
        F.col("record_id").alias("target_id"), F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("digest"))
    wrong = revisits.join(responses, "target_id", "left").where(
        "not (payload_bytes <=> bytes and payload_digest <=> digest)").select("record_id", "target_id").first()
    if wrong:
        raise ValueError(f"revisit {wrong[0]} does not match the response it refers to, {wrong[1]}")
    return rows.drop("record_id", "target_id")


QUERY_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex,
             min(page_id) OVER (PARTITION BY body) AS first_page FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (1 + ((('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)),
           '') AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to
FROM d
"""
