"""Deduplicated WARC archives: revisit resolution over payload digests (op10).

Writing. Only headers (id, digest, length) are shuffled by payload digest; the
largest id of a digest is the response, the others revisit it. The decision is
joined back to the pages, revisits lose their payload, and every record gets
fresh headers. Payloads are shuffled once, by id and digest, into archives of
at most about ``ARCHIVE_BYTES``; a smaller table is dealt to as many archives
as a shuffle has partitions, but none below ``LEAST_BYTES``. Spark's text
writer writes them, gzipped: a record is one row, and the row separator is the
two line ends that close a WARC record. The block of a record is an HTTP
response, its head alone for a revisit.

Reading. Spark's text reader streams an archive line by line; lines are put
together again and cut by Content-Length, so payloads may hold anything and a
task holds a batch of lines and one record, whatever the archive's size.
Revisit records are resolved against the response records by WARC-Refers-To,
which brings back payload and length.

Defined cases: a NULL payload is empty; an empty payload is a payload like any
other, unless it is shorter than ``min_revisit_bytes``, which are always
responses; rows with a NULL id are written without a page header and read back
with a NULL id, and are responses; rows that repeat id and payload are each a
response; an empty table gives an archive without records and an empty result;
only id, URL and payload are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_dir, in_arrow, shuffle_width

#: Most bytes of an archive before compression, about, and the least where that leaves tasks without work.
ARCHIVE_BYTES = 1 << 30
LEAST_BYTES = 8 << 20
CRLF = "\r\n"
#: Fixed date of the records, so that equal input gives equal archives.
DATE = "2024-01-01T00:00:00Z"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: each ten of its digits are eight characters."""
    letters = []
    for k in range(4):
        part = F.conv(F.substring(digest, 10 * k + 1, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            at = F.shiftright(part, shift).bitwiseAND(F.lit(31)).cast("int") + 1
            letters.append(F.substring(F.lit(_BASE32), at, F.lit(1)))
    return F.concat(*letters)


def record_id(page: Column, digest: Column) -> Column:
    """A URN for id and payload, the same in every run."""
    h = F.md5(F.encode(F.concat_ws("/", F.coalesce(page.cast("string"), F.lit("-")), digest), "UTF-8"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write one WARC record a row under ``path``, equal payloads as revisits of the one with the largest id."""
    text = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")), r"[\x00-\x20\x7F]", "")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page"), url.alias("url"), text.alias("payload"),
        F.sha1(F.encode(text, "UTF-8")).alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )
    headers = rows.select("page", "digest", "bytes")
    largest = headers.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(F.max("page").alias("response"))
    decided = (
        headers.where("page is not null").distinct().join(largest, "digest").where("page < response")
        .select("page", "digest", "response")
    )
    total = headers.agg(F.sum(F.col("bytes") + 500)).first()[0] or 0
    archives = max(1, -(-total // archive_bytes), min(shuffle_width(pages.sparkSession), -(-total // LEAST_BYTES)))
    keys = ["page", "digest"]
    records = rows.repartition(archives, *keys).join(decided.repartition(archives, *keys), keys, "left")
    revisit = F.col("response").isNotNull()
    http = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "]
    block = F.concat(
        F.lit(CRLF.join(http)), F.col("bytes").cast("string"), F.lit(CRLF + CRLF), F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    )
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: <"), record_id(F.col("page"), F.col("digest")), F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("digest"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <"), record_id(F.col("response"), F.col("digest")), F.lit(">"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(F.col("page").isNotNull(), F.concat(F.lit("X-Page-ID: "), F.col("page").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)
    records.sortWithinPartitions(*keys).select(record.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)


def parse_records(chunks: Iterator[bytes]) -> Iterator[list[tuple[dict[str, str], bytes]]]:
    """For each chunk of a stream of archives, (headers, payload) of the records that it completes."""
    held = bytearray()
    for chunk in chunks:
        held += chunk
        done, at = [], 0
        while (end := held.find(b"\r\n\r\n", at)) >= 0:
            head = held[at:end].decode("utf-8").split(CRLF)
            if not head[0].startswith("WARC/"):
                raise ValueError(f"no record starts at {head[0][:40]!r}")
            fields = dict(line.split(": ", 1) for line in head[1:])
            close = end + 4 + int(fields["Content-Length"])
            if close + 4 > len(held):
                break
            done.append((fields, bytes(held[held.index(b"\r\n\r\n", end + 4, close) + 4 : close])))
            at = close + 4
        del held[:at]
        yield done
    if held:
        raise ValueError("an archive ends within a record")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(page, url, type, record, refers, digest, bytes[, payload]) of all records below ``path``."""
    schema = "page long, url string, type string, record string, refers string, digest string, bytes long" + ", payload string" * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (b"".join(line + b"\n" for line in batch.column(0).cast(pa.binary()).to_pylist()) for batch in batches)
        for records in parse_records(chunks):
            rows = []
            for head, payload in records:
                if head["WARC-Type"] == "response" and head["WARC-Payload-Digest"] != "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode():
                    raise ValueError(f"payload of {head['WARC-Record-ID']} doesn't match its digest")
                page = head.get("X-Page-ID")
                row = (
                    page and int(page), head["WARC-Target-URI"], head["WARC-Type"], head["WARC-Record-ID"].strip("<>"),
                    head.get("WARC-Refers-To", "").strip("<>") or None, head["WARC-Payload-Digest"].removeprefix("sha1:"), len(payload),
                )
                rows.append((*row, payload.decode("utf-8")) if payloads else row)
            if rows:
                kinds = [pa.int64(), *[pa.string()] * 5, pa.int64(), *[pa.string()] * payloads]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, re.findall(r"(\w+) (?:long|string)", schema))

    # gzip files aren't split, so a task reads whole archives, one after the other and in order
    lines = spark.read.schema("value string").option("lineSep", "\n").option("pathGlobFilter", "part-*.gz").text(path)
    return in_arrow(lines, run, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Each record with the id of the response it refers to and the length (and payload) of the full payload."""
    payload = ["payload"] if "payload" in records.columns else []
    responses = records.where("type = 'response'").select(
        F.col("record").alias("refers"), F.col("page").alias("refers_to"), F.col("bytes").alias("full"), *[F.col(c).alias("whole") for c in payload]
    ).dropDuplicates(["refers"])
    joined = records.join(responses, "refers", "left")
    found = F.col("refers").isNotNull()
    return joined.select(
        "page", "url", "digest", F.col("type").alias("record_type"), "refers_to", F.when(found, F.col("full")).otherwise(F.col("bytes")).alias("payload_bytes"),
        *[F.when(found, F.col("whole")).otherwise(F.col(c)).alias(c) for c in payload],
    )


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write the archives into the shared folder and return what is read back."""
    path = fresh_dir(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, payload_col)
    return resolve_revisits(read_archives(pages.sparkSession, path))
