"""WARC archives as Spark tables: writing, reading, and resolving revisits.

Records are written by Spark's text writer, one record per row: CR LF CR LF is
both what ends a WARC record and the writer's line separator, so each part file
is an archive, and the writer's commit protocol guards against lost tasks.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
#: Revisits are made only of payloads with at least so many bytes.
LEAST_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
RECORDS = "page_id long, record_type string, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def header_table(pages: DataFrame) -> DataFrame:
    """``_id, _url, _digest, _size``: id, url and the payload's digest and length.

    Only headers are shuffled, by digest; the largest id per digest is an aggregate with map-side combine,
    and the join back splits a digest that holds very many rows.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").alias("_id"), F.col("url").alias("_url"), F.sha1(payload).alias("_digest"),
        F.octet_length(payload).cast("long").alias("_size"),
    )


def originals(headers: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``digest, original, source`` for each digest of at least ``least`` bytes with more than one record: the largest
    id and its url, the last one of a repeated id."""
    return (
        headers.where(F.col("_size") >= least)
        .groupBy(F.col("_digest").alias("digest"))
        .agg(F.max(F.struct("_id", "_url")).alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", F.col("last._id").alias("original"), F.col("last._url").alias("source"))
    )


def line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def clean(value: Column) -> Column:
    """Header values hold no line breaks; they are percent-encoded."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record_name(page_id: Column, digest: Column) -> Column:
    """A record's id, derived from digest and page id, so that a repeated task writes the same bytes."""
    name = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    parts = [F.substring(name, first, size) for first, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record(page_id: Column, url: Column, digest: Column, original: Column, source: Column, payload: Column, date: str) -> Column:
    """One archive record: an HTTP head and the payload; a revisit, which has an ``original`` with the url
    ``source``, has the head only."""
    revisit = original.isNotNull()
    head = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(payload).cast("string")),
        F.lit(CRLF),
    )
    block = F.when(revisit, head).otherwise(F.concat(head, payload))
    refers = F.concat(
        line("WARC-Profile", F.lit(PROFILE)),
        line("WARC-Refers-To", record_name(original, digest)),
        F.coalesce(line("WARC-Refers-To-Target-URI", clean(source)), F.lit("")),
        line("WARC-Refers-To-Date", F.lit(date)),
        line("X-Refers-To-Page-ID", original.cast("string")),
    )
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_name(page_id, digest)),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", clean(url)), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("X-Page-ID", F.coalesce(page_id.cast("string"), F.lit(""))),
        F.when(revisit, refers).otherwise(F.lit("")),
        line("Content-Type", F.lit(HTTP)),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
    )


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, codec: str = "gzip", date: str | None = None) -> None:
    """Write a record per row of ``pages`` (page_id, url, html), payloads of revisits left out.

    ``date`` is the WARC-Date of all records, by default when the run began: it is set once, so a repeated task
    states the same.

    Null html is an empty payload, a null url has no target header.  Rows that repeat a page_id
    with the same payload are all written; the last id of a digest stays the response, and of
    rows that share that id too, all are responses.
    """
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select("page_id", "url", "html").withColumn("_digest", digest)
    headers = header_table(pages)
    whole = originals(headers, least)
    revisits = (
        headers.where(F.col("_size") >= least)
        .join(whole, F.col("_digest") == F.col("digest"))
        .where("_id <> original or _id is null")
        .select("_id", F.col("_digest").alias("_of"), "original", "source")
        .distinct()
    )
    told = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_of")), "left")
    payload = F.coalesce("html", F.lit(""))
    text = record(F.col("page_id"), F.col("url"), F.col("_digest"), F.col("original"), F.col("source"), payload, date)
    told.select(text.alias("value")).write.option("lineSep", CRLF * 2).option("compression", codec).mode(
        "overwrite"
    ).text(path)


def parse(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, with lower-case names, and block of each record, one record at a time; blocks are cut by their stated
    length."""
    while first := archive.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record before byte {archive.tell()}")
        headers = {}
        while (one := archive.readline().rstrip(b"\r\n")):
            name, _, value = one.decode("utf-8").partition(":")
            headers[name.lower()] = value.strip(" ")
        size = int(headers["content-length"])
        block = archive.read(size)
        if len(block) < size or archive.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, block


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP head of a block that has one."""
    return block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder; one task holds one archive file, packed, and unpacks a record at a time.

    ``payload_bytes`` and ``payload_digest`` of responses are computed from what follows the HTTP head; the
    digest stated in the header must agree.  Those of revisits are still to be resolved: the digest is the stated one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for blob in batch.column(0):
                data, rows, held = io.BytesIO(blob.as_buffer()), [], 0
                packed = data.getbuffer()[:2] == b"\x1f\x8b"
                for h, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=data)) if packed else data):
                    kind, stated = h["warc-type"], h["warc-payload-digest"].removeprefix("sha1:")
                    block = payload_of(h, block)
                    if kind == "response" and hashlib.sha1(block).hexdigest() != stated:
                        raise ValueError(f"record {h['warc-record-id']} is damaged")
                    rows.append(
                        (
                            _number(h.get("x-page-id")), kind, h.get("warc-target-uri"),
                            len(block) if kind == "response" else None, stated,
                            _number(h.get("x-refers-to-page-id")), block if payloads else None,
                        )
                    )
                    held += len(block)
                    if held > 8_000_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """Give revisits the payload length of the response they refer to.

    Joined by digest and page id; one response per pair is taken, so repeated rows are not
    multiplied.  A revisit whose response is in no archive keeps a null length.
    """
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes")
    responses = (
        records.where("record_type = 'response'")
        .groupBy(F.col("payload_digest").alias("_digest"), F.col("page_id").alias("_page"))
        .agg(F.max("payload_bytes").alias("payload_bytes"))
    )
    found = revisits.join(
        responses, (F.col("payload_digest") == F.col("_digest")) & (F.col("refers_to") == F.col("_page")), "left"
    ).drop("_digest", "_page")
    return records.where("record_type = 'response'").unionByName(found)


def dedup_archives(spark: SparkSession, source: str, target: str, least: int = LEAST_BYTES) -> None:
    """Read archives, revisits among them, and write them again deduplicated, with fresh headers.

    A revisit in the source gets the payload of its response before digests are compared.
    """
    records = read_archives(spark, source)
    payloads = records.where("record_type = 'response'").select(
        F.col("payload_digest").alias("_digest"), F.col("page_id").alias("_page"), F.col("payload").alias("_payload")
    ).dropDuplicates(["_digest", "_page"])
    whole = records.join(
        payloads,
        (F.col("record_type") == "revisit") & (F.col("payload_digest") == F.col("_digest")) & (F.col("refers_to") == F.col("_page")),
        "left",
    )
    html = F.coalesce(F.col("_payload"), F.col("payload")).cast("string")
    write_archives(whole.select("page_id", "url", html.alias("html")), target, least)


def new_folder(spark: SparkSession) -> str:
    """A fresh folder for archives in the shared working folder."""
    from cartwright.session import shared_dir

    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
