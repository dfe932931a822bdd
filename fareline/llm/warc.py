"""WARC archives with revisit resolution.

Headers (page, payload digest, size) are shuffled by payload digest; of equal
payloads of at least ``min_payload`` bytes the one with the largest page_id
stays a response, the others become revisit records that refer to it. The
archives are written by Spark's own text writer: a row is a record up to its
closing two line ends, which are the writer's line separator. So tasks commit
their files as for any other output and a lost executor costs a retry. Reading
back cuts each file along Content-Length, hashes the payloads again, and joins
the revisits to their responses by record id.

Defined results: null html is an empty payload; a null url leaves the target
header out; a null page_id is smaller than any other; rows that tie for
the largest page_id of a payload all stay responses; an empty table gives no
records; other columns are not looked at. Payloads are stored whole.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import arrow_batches, whole_text, written

# Fixed values of the format.
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 20_000       # an archive is read by one task: bounds its size


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: four times 40 bits as eight digits."""
    h = F.sha1(payload)
    digits = F.concat(*(F.lpad(F.conv(F.substring(h, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit(""))))
    parts = [F.substring(h, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, nothing for a null value; line ends inside are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def resolve(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """page_id, url, payload, size, digest, original (page_id referred to, null for a response)."""
    payload = whole_text(F.col("html"))
    heads = pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).alias("size"),
                         base32_sha1(payload).alias("digest"))
    groups = (heads.where(F.col("size") >= min_payload).groupBy("digest")
              .agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    # written first: the join then knows its size, and both sides come straight from an exchange
    joined = heads.join(written(groups.select("digest", "latest"), "warc-groups"), "digest", "left")
    revisit = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return joined.select("page_id", "url", "payload", "size", "digest", F.when(revisit, F.col("latest")).alias("original"))


def write_archives(resolved: DataFrame, path: str) -> None:
    """WARC 1.1 files, uncompressed, one record per row, with fresh headers."""
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, record_id(F.col("original")))),
        _line("X-Page-Id", F.col("page_id")),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"))
    (resolved.select(F.concat(head, block).alias("record")).write.option("lineSep", END)
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


RECORDS = "record_type string, record_id string, refers_to_id string, page_id long, url string, size long, digest string"


def _records(batches):
    """Records of whole archive files: cut along Content-Length, payloads hashed."""
    schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()),
                        ("page_id", pa.int64()), ("url", pa.string()), ("size", pa.int64()), ("digest", pa.string())])
    for batch in batches:
        for content in batch.column("content"):
            data, at, rows = content.as_buffer(), 0, []
            view, raw = memoryview(data), data.to_pybytes()
            while at < len(raw):
                end = raw.index(b"\r\n\r\n", at)
                head = dict(x.split(b": ", 1) for x in raw[at:end].split(b"\r\n")[1:])
                start, n = end + 4, int(head[b"Content-Length"])
                if raw[at:at + 8] != b"WARC/1.1" or raw[start + n:start + n + 4] != b"\r\n\r\n":
                    raise ValueError("not a WARC record")
                body = raw.index(b"\r\n\r\n", start) + 4
                response = head[b"WARC-Type"] == b"response"
                payload = view[body:start + n]
                digest = (base64.b32encode(hashlib.sha1(payload).digest()) if response
                          else head[b"WARC-Payload-Digest"].split(b":")[1]).decode()
                page, uri, to = head.get(b"X-Page-Id"), head.get(b"WARC-Target-URI"), head.get(b"WARC-Refers-To")
                rows.append((head[b"WARC-Type"].decode(), head[b"WARC-Record-ID"].decode(), to.decode() if to else None,
                             int(page) if page else None, uri.decode() if uri is not None else None,
                             len(payload) if response else None, digest))
                at = start + n + 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [()] * 7, schema)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``; size is null for revisits."""
    arrow_batches(spark, 1)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_records, RECORDS)


def with_responses(records: DataFrame) -> DataFrame:
    """Records with the size and page_id of the response that a revisit refers to."""
    to = records.where("record_type = 'revisit'").select(F.col("refers_to_id").alias("id")).distinct()
    found = (records.where("record_type = 'response'").join(to, F.col("record_id") == F.col("id"), "left_semi")
             .groupBy(F.col("record_id").alias("id")).agg(F.max("page_id").alias("to_page"), F.max("size").alias("to_size")))
    return (records.join(written(found, "warc-responses"), F.col("refers_to_id") == F.col("id"), "left")
            .select("page_id", F.coalesce("size", "to_size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                    "record_type", F.col("to_page").alias("refers_to")))


def warc_report(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Write the archives, read them back, resolve the revisits."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(resolve(pages, min_payload), path)
    return with_responses(written(read_archives(spark, path), "warc-records"))


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits FROM pages
), d AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
         + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
         + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY t) AS latest FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM latest AND latest IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM g
"""
