"""WARC derivatives: a metadata and a plain-text conversion record for each response record.

Both derived records point at their response by WARC-Refers-To and share its target URI and date; the metadata
record carries the response's HTTP headers and digests, the conversion record the extracted text with its
own digests. Record ids of derivatives follow from the response's id and the type, so a rerun gives the same ones.

Rows: records of other types are left out; a null payload counts as empty; a record without an id gives derivatives whose ids follow from its payload; a payload without an HTTP head
is all body; repeated rows, and ties of ids, are derived once each; very long payloads are read whole; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import text_batches
from wordloom.llm.htmlblocks import main_text

SCHEMA = "source_id long, record_id string, record_type string, refers_to string, target_uri string, date string, content_type string, content_length long, block_digest string, payload_digest string, block binary"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(payload: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body."""
    head, sep, body = payload.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"HTTP/"):
        return "", [], payload
    lines = head.decode("latin-1").split("\r\n")
    return lines[0], [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]) if k.strip()], body


def derive(record_id: str, payload: bytes) -> list[tuple[str, str, str, bytes, str | None]]:
    """(type, id, content type, block, payload digest) of both derivatives; ids of a record without one follow from its content."""
    record_id = record_id or f"block:{digest(payload)}"
    status, headers, body = split_http(payload)
    ours = lambda kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{kind}')}>"
    fields = [("status", status), *((f"http-header-{k.lower()}", v) for k, v in headers), ("source-block-digest", digest(payload)), ("source-payload-digest", digest(body)), ("source-length", str(len(payload)))]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    text = main_text(body.decode("utf-8", "replace")).encode("utf-8", "surrogatepass")
    return [("metadata", ours("metadata"), "application/warc-fields", meta, None), ("conversion", ours("conversion"), "text/plain; charset=utf-8", text, digest(text))]


def derivatives(records: DataFrame) -> DataFrame:
    """records: source_id, record_id, record_type, target_uri, date, block (binary) -> two rows for each response."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch, "block", 16 << 20):
                rows = []
                for source, record, uri, date, block in zip(*(c.to_pylist() for c in batch.slice(lo, hi - lo).columns)):
                    for kind, ours, content, data, payload in derive(record or "", block or b""):
                        rows.append((source, ours, kind, record, uri, date, content, len(data), digest(data), payload, data))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64() if n in ("source_id", "content_length") else pa.binary() if n == "block" else pa.string()) for n, c in zip(names, columns)], names=names)

    responses = records.where(F.lower("record_type") == "response")
    return responses.select(F.col("source_id").cast("long"), "record_id", "target_uri", "date", "block").mapInArrow(run, SCHEMA)


def as_responses(pages: DataFrame, date: str = "2020-01-01T00:00:00Z", key: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """Pages as response records: an HTTP head of our own before the page."""
    body = F.coalesce(F.col(markup).cast("string"), F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    h = F.md5(F.concat_ws("\u0001", F.col(key).cast("string"), F.col(url).cast("string")).cast("binary"))
    record = F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))
    return pages.select(F.col(key).cast("long").alias("source_id"), record.alias("record_id"), F.lit("response").alias("record_type"), F.col(url).cast("string").alias("target_uri"), F.lit(date).alias("date"), F.concat(head.cast("binary"), body).alias("block"))


def serialize(records: DataFrame) -> DataFrame:
    """The records of ``derivatives`` as WARC/1.1 bytes, column ``warc``."""
    line = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit("\r\n"))).otherwise("")
    head = F.concat(F.lit("WARC/1.1\r\n"), *(line(n, c) for n, c in (("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"), ("WARC-Payload-Digest", "payload_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"))), F.lit("\r\n"))
    return records.withColumn("warc", F.concat(head.cast("binary"), F.col("block"), F.lit("\r\n\r\n").cast("binary")))
