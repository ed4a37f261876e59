"""WARC archives in which equal payloads are stored once.

Writing: each row's payload digest and length come first. Only these headers are
shuffled: the first row of each digest is found by a grouped minimum, and joined back
to the headers of the others, which become revisit records that name it. Archives
are written by Spark's text writer with the record separator of the format as line
separator, one record a row, so any storage and its commit protocol will do.

Reading: each archive file is one cell of Spark's binary reader, cut into records by
the stated lengths. Archives hold a bounded number of records each.

Existing archives are resolved the same way: revisits that they hold are joined to
the original responses by digest, and fresh archives are written.

Defined cases: a null payload is empty; a null url is an empty target; rows that agree
in page id and payload are alike responses or alike revisits; a null page id is a
response only where no page with an id has the payload; an empty table writes no
records; other columns are not stored.
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

from ragtables.llm.base import sent
from ragtables.sources.storage import materialize

# Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2000-01-01T00:00:00Z"

RECORDS_PER_FILE = 10_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four base32 digits."""
    hexed = F.sha1(payload.cast("binary"))
    digits = [
        F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def page_records(pages: DataFrame) -> DataFrame:
    """Response records, not yet written, of ``page_id, url, html``."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        "page_id",
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.lit("response").alias("record_type"),
        base32_sha1(payload).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.lit(None).cast(pages.schema["page_id"].dataType).alias("refers_to"),
        payload.alias("payload"),
    )


def revisits_of(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Headers of the records that become or stay revisits, with the original
    response of their digest: that with the least page id. A revisit whose original
    is not among the records keeps what it refers to."""
    heads = materialize(records.drop("payload"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("first")
    originals = (
        heads.filter((F.col("record_type") == "response") & (F.col("payload_bytes") >= least_bytes))
        .groupBy("payload_digest", "payload_bytes")
        .agg(first)
    )
    joined = heads.join(originals, ["payload_digest", "payload_bytes"], "left")
    copy = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return joined.filter((F.col("record_type") == "revisit") | copy).select(
        "page_id",
        "url",
        F.lit("revisit").alias("record_type"),
        "payload_digest",
        "payload_bytes",
        F.when(F.col("first").isNull(), F.col("refers_to")).otherwise(F.col("first.page_id")).alias("refers_to"),
        F.col("first.url").alias("refers_url"),
    )


def _record(**extra: Column) -> Column:
    """The text of a record without the separator that ends it."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))

    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    number = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    parts = [
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", number),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(PROFILE)),
                line(
                    "WARC-Refers-To",
                    F.concat(F.lit("<urn:page:"), F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.lit(">")),
                ),
                line("WARC-Refers-To-Target-URI", F.regexp_replace(F.coalesce("refers_url", F.lit("")), r"[\r\n]+", " ")),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body)),
        F.lit(CRLF),
        body,
    ]
    return F.concat(*parts)


def write_archives(
    records: DataFrame, path: str, least_bytes: int = 0, per_file: int = RECORDS_PER_FILE
) -> str:
    """Writes records with equal payloads stored once and fresh headers.

    Payloads are not shuffled: a response is written where it is read unless its
    header turned into a revisit.
    """
    revisits = materialize(revisits_of(records, least_bytes))
    gone = revisits.select(
        F.col("page_id").alias("gone_id"), F.col("payload_digest").alias("gone_digest")
    ).distinct()
    gone = materialize(gone)
    same = F.col("page_id").eqNullSafe(F.col("gone_id")) & (F.col("payload_digest") == F.col("gone_digest"))
    responses = records.filter("record_type = 'response'").join(sent(gone), same, "left_anti")
    for rows in (
        responses.withColumn("refers_url", F.lit(None).cast("string")),
        revisits.withColumn("payload", F.lit("")),
    ):
        (
            rows.select(_record().alias("value"))
            .write.mode("append")
            .option("lineSep", CRLF * 2)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", per_file)
            .text(path)
        )
    return path


def _records(stream: gzip.GzipFile) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and body of each record of an archive."""
    while line := stream.readline():
        if line.decode().strip() != VERSION:
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        fields = {}
        while line := stream.readline().decode().rstrip(CRLF):
            name, _, value = line.partition(": ")
            fields[name] = value
        body = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != CRLF.encode() * 2:
            raise ValueError("a record does not end where its length says")
        yield fields, body


def _page(urn: str | None) -> str | None:
    return (urn or "")[len("<urn:page:") : -1] or None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
            ("refers_to", pa.string()), ("payload", pa.string()),
        ]
    )
    for batch in batches:
        for content in batch["content"]:
            rows, held = [], 0
            with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as stream:
                for fields, body in _records(stream):
                    kind = fields["WARC-Type"]
                    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != named:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                    rows.append(
                        (
                            _page(fields["WARC-Record-ID"]),
                            fields.get("WARC-Target-URI", ""),
                            kind,
                            named,
                            len(body) if kind == "response" else int(fields["X-Payload-Length"]),
                            _page(fields.get("WARC-Refers-To")),
                            body.decode() if kind == "response" else None,
                        )
                    )
                    held += len(body)
                    if held > 4_000_000 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                        )
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """The records of the archives in a folder: ``page_id, url, record_type,
    payload_digest, payload_bytes, refers_to, payload`` (null for revisits). Digests
    of responses are checked."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    rows = files.select("content").mapInArrow(
        _parse,
        "page_id string, url string, record_type string, payload_digest string,"
        " payload_bytes long, refers_to string, payload string",
    )
    ids = {n: F.col(n).cast(id_type) for n in ("page_id", "refers_to")}
    return rows.withColumns(ids)


def resolved_headers(records: DataFrame) -> DataFrame:
    """Headers of read records; a revisit has the length of the response that it
    refers to, found by digest."""
    heads = materialize(records.drop("payload"))
    originals = heads.filter("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("full_bytes")
    ).distinct()
    full = heads.filter("record_type = 'revisit'").join(originals, ["refers_to", "payload_digest"], "left")
    names = ["page_id", "url", "payload_digest", "record_type", "refers_to"]
    return (
        heads.filter("record_type = 'response'").select(*names, "payload_bytes")
        .unionByName(full.select(*names, F.coalesce("full_bytes", "payload_bytes").alias("payload_bytes")))
    )
