"""Operator 8: WARC archives with revisit records.

Headers (page id, payload digest) are shuffled by digest; in each digest the smallest page id is the original
response, and the other pages' records are joined to it and written as revisits, with an HTTP header but without the
payload.  The archives are gzip files of bounded size, written and read through Spark's own file systems.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limes.llm.common import arrow_fields, columns, join_counted, prepare, shared_folder, stored, tidy

#: Bytes of payload in an archive, about; a record is never split.
ARCHIVE_BYTES = 16 << 20
#: Bytes of payload in a batch of read records, about.
BATCH_BYTES = 8 << 20
ROWS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, content binary"
END = b"\r\n\r\n"
EPOCH = "1970-01-01T00:00:00Z"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """RFC 4648 base32 of 20 bytes given as hexadecimal digits: 10 digits (40 bits) make 8 letters."""
    digits = F.concat(*[F.lpad(F.conv(F.substring(hexadecimal, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", ALPHABET)


def headers(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest of each page; a null html is the empty payload."""
    rows = columns(pages, page_id="long", url="string", html="string").withColumn("html", F.coalesce("html", F.lit("")))
    return rows.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": base32(F.sha1(F.col("html").cast("binary")))})


def resolve(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """id, digest, first (page_id and url of the response that holds the payload) of each page that revisits another.

    Headers alone are shuffled by digest.  Originals are found by aggregation, which also runs in the map tasks; revisit
    records are joined to them where they are if a digest is hot, so one digest of a third of all rows is no burden.
    Payloads under `smallest` bytes are all responses.
    """
    head = headers(pages).filter(F.col("page_id").isNotNull() & (F.col("payload_bytes") >= smallest)).select(F.col("page_id").alias("id"), F.col("payload_digest").alias("digest"), F.struct("page_id", "url").alias("me"))
    first = stored(head.groupBy("digest").agg(F.min("me").alias("first"), F.count("*").alias("n"), F.max("id").alias("last")).filter("first.page_id < last").drop("last"))
    total = first.agg(F.sum("n")).first()[0] or 0
    return join_counted(head.drop("me"), first, "digest", total).filter("id <> first.page_id").select("id", "digest", "first").distinct()


def record(date: str) -> Column:
    """The text of a record, without the two line ends that close it: its header, and the page's HTTP header and payload."""
    name = lambda page, digest: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), digest, F.lit(">"))
    uri = lambda url: F.regexp_replace(F.coalesce(url, F.lit("about:blank")), r"[\x00-\x20]", "%20")
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    revisit = F.col("first").isNotNull()
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    body = F.when(revisit, answer).otherwise(F.concat(answer, F.col("html")))
    refers = F.concat(
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To", name(F.col("first.page_id"), F.col("payload_digest"))),
        line("WARC-Refers-To-Target-URI", uri(F.col("first.url"))),
        line("WARC-Refers-To-Date", F.lit(date)),
    )
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("page_id"), F.col("payload_digest"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(revisit, refers).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
    )


def write_archives(pages: DataFrame, folder: str, smallest: int = 0, date: str = EPOCH) -> str:
    """Write a record per row of pages to gzip archives in folder, of about ARCHIVE_BYTES of payload each.

    Rows with a null id are responses, and so is each repeated row of a response; rows that repeat an id with another payload are records of their
    own.  A payload of any length is one record.  An empty table writes no record.  Columns besides page_id, url and
    html are left out; date stands in every record, for the table has none.
    """
    prepare(pages.sparkSession)
    total = columns(pages, html="string").agg(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    parts = max(1, -(-total // ARCHIVE_BYTES))
    # the payloads' one shuffle, by page and digest, serves both the join and the size of the archives
    rows = headers(pages).withColumn("at", F.coalesce("page_id", F.xxhash64("url", "payload_digest")))
    links = resolve(pages, smallest).repartition(parts, "id", "digest")
    joined = rows.repartition(parts, "at", "payload_digest").join(links, (F.col("at") == F.col("id")) & (F.col("payload_digest") == F.col("digest")), "left")
    joined = joined.withColumn("first", F.when(F.col("page_id").isNotNull(), F.col("first")))
    with tidy(pages.sparkSession):
        joined.select(record(date).alias("value")).write.option("lineSep", END.decode()).option("compression", "gzip").text(folder)
    return folder


def parse(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and payload of each record of an archive, framed by Content-Length; one record is held at a time."""
    while first := archive.readline():
        if not first.startswith(b"WARC/1."):
            raise ValueError(f"no record begins with {first[:20]!r}")
        head = {}
        while (line := archive.readline()) != b"\r\n":
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[key] = value
        block = archive.read(int(head["Content-Length"]))
        if archive.read(len(END)) != END:
            raise ValueError(f"no end of the record {head['WARC-Record-ID']}")
        answer, _, payload = block.partition(END)
        head["payload"] = re.search(rb"\r\nContent-Length: (\d+)", answer)[1].decode()
        yield head, payload


def read_archives(spark, folder: str) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to, content of each record in the archives.

    The digest and length of a response's payload are computed anew and must agree with its header.
    """
    kinds = arrow_fields(ROWS)

    def number(name: str | None) -> int | None:
        value = (name or "::null:").split(":")[2]
        return None if value == "null" else int(value)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], [c for c, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for packed in files.column(0):
                rows, held = [], 0
                for head, content in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(packed.as_py())), 1 << 20)):
                    digest, length = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["payload"])
                    if head["WARC-Type"] == "response" and (len(content) != length or base64.b32encode(hashlib.sha1(content).digest()).decode() != digest):
                        raise ValueError(f"{head['WARC-Record-ID']}: the payload doesn't match its digest")
                    rows.append((number(head["WARC-Record-ID"]), head["WARC-Target-URI"], head["WARC-Type"], length, digest, number(head.get("WARC-Refers-To")), content))
                    held += len(content)
                    if len(rows) == 500 or held > BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(run, ROWS)


def round_trip(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """The records of pages, read back from archives written to a new folder beside the checkpoints."""
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read_archives(pages.sparkSession, write_archives(pages, folder, smallest))
