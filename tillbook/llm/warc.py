"""WARC (6): archives of request, response and metadata records, assembled into one row per capture.

Writing. Each page gives three records: the response (or a revisit of an earlier equal payload), the
request and a metadata record that holds the page id; the last two name the first in
WARC-Concurrent-To. A WARC record ends with two empty lines, so Spark's text sink with that line
separator writes plain WARC files, with its commit protocol and on any file system it reaches.
Files hold about ``FILE_BYTES`` (the number of records a file is set from the mean record).

Reading. Each file is parsed by its Content-Length fields. Requests and metadata are aggregated by
the record they are concurrent to and joined with responses and revisits; revisits are joined with
the response they refer to, whose stored payload gives their size and digest.

Equal payloads are those of equal SHA-1 and length. Of those of ``REVISIT_BYTES`` or more, the
record with the largest page_id is the response and the others revisit it; records that tie for the
largest id are all responses. A null page_id counts as smaller than any; if a payload has no other
id, all are responses. Null html is an empty payload; a null url writes no target. Line breaks in a
url are percent-encoded. Rows that repeat page_id and payload share their record ids; each gives one
capture, with the greatest of the requests and metadata. An empty table gives no files and no rows.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import keep, table
from tillbook.session import configure, scratch_path

REVISIT_BYTES = 1000
FILE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

_RECORDS = ("record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, date string, "
            "page_id long, payload_bytes long, payload_digest string, payload binary")


def _urn(page_id, digest: str, role: str):
    hex_ = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), F.col(digest), F.lit(role)).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(hex_, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _record(kind, record_id, block, **headers):
    """A record's text; ``headers`` whose value is null are left out."""
    fields = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {DATE}")]
    fields += [F.concat(F.lit(f"WARC-{n.replace('_', '-')}: "), v) for n, v in headers.items()]
    fields.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", *fields), F.lit(END), block)


def records(pages: DataFrame) -> DataFrame:
    """The records of ``pages`` (page_id, url, html) as texts (column value), and their number of bytes."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"),
                         html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
                         F.octet_length(html).cast("long").alias("bytes"))
    first = keep(pages.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest", "bytes").agg(
        F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1 and original is not null").drop("n"), "warc-first")
    joined = pages.join(first, ["digest", "bytes"], "left")
    revisit = F.col("original").isNotNull() & F.coalesce(F.col("page_id") < F.col("original"), F.lit(True))
    rows = joined.select("*", revisit.alias("revisit"), _urn(F.col("page_id"), "digest", "capture").alias("id"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    uri, digest = F.col("url"), F.concat(F.lit("sha1:"), F.col("digest"))
    capture = _record(F.when(F.col("revisit"), "revisit").otherwise("response"), F.col("id"), F.concat(head, F.when(F.col("revisit"), "").otherwise(F.col("html"))),
                      Target_URI=uri, Payload_Digest=digest,
                      Refers_To=F.when(F.col("revisit"), _urn(F.col("original"), "digest", "capture")),
                      Profile=F.when(F.col("revisit"), PROFILE))
    request = _record(F.lit("request"), _urn(F.col("page_id"), "digest", "request"),
                      F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1"), F.lit(END)),
                      Target_URI=uri, Concurrent_To=F.col("id"))
    metadata = _record(F.lit("metadata"), _urn(F.col("page_id"), "digest", "metadata"),
                       F.concat(F.lit("pageId: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n")),
                       Target_URI=uri, Concurrent_To=F.col("id"))
    return rows.select(F.explode(F.array(request, capture, metadata)).alias("value"))


def write(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write the archives of ``pages`` to the folder ``path``."""
    configure(pages.sparkSession)
    mean = pages.agg(F.avg(F.octet_length(F.coalesce("html", F.lit("")))) + 1000).first()[0] or 1000
    per_file = max(3, int(3 * file_bytes / mean))
    records(pages).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


def _parse(data: bytes, payloads: bool):
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        block = memoryview(data)[stop + 4:stop + 4 + size]
        at = stop + 4 + size + 4
        kind, page, payload = head["WARC-Type"], None, None
        if kind == "metadata":
            field = bytes(block).decode("utf-8").split("pageId: ", 1)[1].strip()
            page = int(field) if field else None
        elif kind == "response":
            payload = block[data.index(b"\r\n\r\n", stop + 4) + 4 - stop - 4:]
        yield {"record_id": head["WARC-Record-ID"], "record_type": kind, "concurrent_to": head.get("WARC-Concurrent-To"),
               "refers_to": head.get("WARC-Refers-To"), "target_uri": head.get("WARC-Target-URI"), "date": head["WARC-Date"],
               "page_id": page, "payload_bytes": None if payload is None else len(payload),
               "payload_digest": None if payload is None else hashlib.sha1(payload).hexdigest(),
               "payload": bytes(payload) if payloads and payload is not None else None}


_ARROW = pa.schema([(n, pa.string()) for n in ("record_id", "record_type", "concurrent_to", "refers_to", "target_uri", "date")]
                   + [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _parser(payloads: bool):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                held, size = [], 0
                for r in _parse(batch.column("content")[k].as_buffer().to_pybytes(), payloads):
                    held.append(r)
                    size += 500 + len(r["payload"] or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
    return run


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in a folder; ``payloads`` False leaves the column payload null."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_parser(payloads), _RECORDS)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: page_id, record_type, payload_bytes, payload_digest, refers_to (a page_id) and
    the nested records request, capture and metadata."""
    part = F.struct("record_id", "target_uri", "date", "page_id")
    parts = found.where("record_type in ('request', 'metadata')").groupBy(F.col("concurrent_to").alias("id")).agg(
        F.max(F.when(F.col("record_type") == "request", part)).alias("request"),
        F.max(F.when(F.col("record_type") == "metadata", part)).alias("metadata"))
    main = found.where("record_type in ('response', 'revisit')").select(
        "record_id", "record_type", "refers_to", "payload_bytes", "payload_digest",
        F.struct("record_id", "target_uri", "date", "payload").alias("capture"))
    captures = keep(main.join(parts, main.record_id == parts.id, "left").drop("id"), "warc-captures")
    original = F.struct(F.col("metadata.page_id").alias("page_id"), "payload_bytes", "payload_digest")
    originals = keep(captures.where("record_type = 'response'").groupBy(F.col("record_id").alias("original_id")).agg(
        F.max(original).alias("original")), "warc-originals")
    joined = captures.join(originals, captures.refers_to == originals.original_id, "left")
    return joined.select(F.col("metadata.page_id").alias("page_id"),
                         F.coalesce("payload_bytes", "original.payload_bytes").alias("payload_bytes"),
                         F.coalesce("payload_digest", "original.payload_digest").alias("payload_digest"), "record_type",
                         F.col("original.page_id").alias("refers_to"), "request", "capture", "metadata")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the whole pages table, written as archives and assembled from them."""
    path = scratch_path(configure(spark), "warc")
    write(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    found = keep(read(spark, path, payloads=False), "warc-records")
    return assemble(found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
             max(page_id) OVER (PARTITION BY h) AS original FROM p),
r AS (SELECT *, payload_bytes >= {REVISIT_BYTES} AND original IS NOT NULL AND coalesce(page_id < original, TRUE) AS again FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN original END AS refers_to FROM r
"""
