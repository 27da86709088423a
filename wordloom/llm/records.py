"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record is the payload's length (8 bytes), that length's masked CRC-32C, the payload and the payload's masked CRC-32C, all little-endian, so any
reader of such record files can take it. The payload is one flag byte (1: there is a doc_id; 2: ids take four bytes, else two), the doc_id (8 bytes)
and the ids. Rows are dealt to files by ranges of (doc_id, row), so the files in order hold ascending doc_ids, and a doc_id that many rows share is spread
over several files. Each task writes one file under a name of its own and hands its index rows to Spark, whose commit decides which attempt counts:
the file of a lost or repeated attempt is named by no index row. The index is a Parquet table of its own: doc_id, file, at, size, n_tokens, first_token
(ids before it in its file) and chunk (stretches of ``CHUNK`` bytes, for reading in parallel).

Rows: null and empty text: the end id alone. Null doc_ids come first. Rows with one doc_id follow each other in the order of the input's rows; repeated rows get a record each.
Very long texts are one record. An empty table gives no files and an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm._shared import scratch_dir, staged, text_batches
from wordloom.llm.checksums import crc32c, masked
from wordloom.llm.word_encoder import word_encoder

CHUNK = 8 << 20
HEAD, TAIL, LABEL = 12, 4, 9
_INDEX = "doc_id long, file string, part int, at long, size long, n_tokens long, first_token long, chunk int"


def filesystem(uri: str):  # noqa: ANN201
    """The file system of a folder that all executors share, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def framed(payloads: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The records of ``payloads`` one after the other, and the place of each with that of the end."""
    size = np.fromiter(map(len, payloads), dtype="<u8", count=len(payloads))
    at = np.append(0, np.cumsum(size.astype(np.int64) + HEAD + TAIL))
    heads = np.frombuffer(size.tobytes(), dtype=np.uint8)
    body = np.frombuffer(b"".join(payloads), dtype=np.uint8)
    stop = np.cumsum(size.astype(np.int64))
    head_sum = masked(crc32c(heads, np.arange(0, 8 * len(size), 8), np.full(len(size), 8))).astype("<u4")
    body_sum = masked(crc32c(body, stop - size.astype(np.int64), size.astype(np.int64))).astype("<u4")
    parts: list[bytes] = []
    for i, p in enumerate(payloads):
        parts += (size[i : i + 1].tobytes(), head_sum[i : i + 1].tobytes(), p, body_sum[i : i + 1].tobytes())
    return b"".join(parts), at


def unframed(data: bytes) -> list[bytes]:
    """The payloads of whole records; raises where a length or a checksum doesn't hold."""
    raw, at, spots = np.frombuffer(data, dtype=np.uint8), 0, []
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        if at + HEAD + size + TAIL > len(data):
            raise ValueError(f"the record at byte {at} is cut off or its length is wrong")
        spots.append((at, size))
        at += HEAD + size + TAIL
    start, size = (np.array(x, dtype=np.int64) for x in zip(*spots)) if spots else (np.zeros(0, dtype=np.int64),) * 2
    for place, length, told in ((start, np.full(len(start), 8), start + 8), (start + HEAD, size, start + HEAD + size)):
        stored = np.stack([raw[told + i] for i in range(4)], axis=1).copy().view("<u4").ravel() if len(start) else np.zeros(0, dtype=np.uint32)
        wrong = np.flatnonzero(masked(crc32c(raw, place, length)) != stored)
        if len(wrong):
            raise ValueError(f"the checksum of the record at byte {start[wrong[0]]} doesn't hold")
    return [data[s + HEAD : s + HEAD + n] for s, n in spots]


def payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    flag = (doc_id is not None) | (2 if width == 4 else 0)
    return bytes([flag]) + (doc_id or 0).to_bytes(8, "little", signed=True) + ids


def parsed(data: bytes) -> tuple[int | None, np.ndarray]:
    """doc_id and ids of a payload."""
    return int.from_bytes(data[1:LABEL], "little", signed=True) if data[0] & 1 else None, np.frombuffer(data, dtype="<u4" if data[0] & 2 else "<u2", offset=LABEL)


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode, write the files of ``folder`` and return the index, staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        width = encoder.width if end_id < 1 << 16 else 4
        end, part = end_id.to_bytes(width, "little"), TaskContext.get().partitionId()
        name, sink, at, tokens = f"part-{part:06d}-{uuid.uuid4().hex}.records", None, 0, 0
        try:
            for batch in batches:
                for lo, hi in text_batches(batch, "text"):
                    rows = batch.slice(lo, hi - lo)
                    if sink is None:
                        system, path = filesystem(folder)
                        system.create_dir(path, recursive=True)
                        sink = system.open_output_stream(f"{path}/{name}")
                    keys = rows.column(0).to_pylist()
                    ids = encoder.packed([t or "" for t in rows.column(1).to_pylist()])
                    if width != encoder.width:
                        ids = [np.frombuffer(x, dtype=f"<u{encoder.width}").astype("<u4").tobytes() for x in ids]
                    n = np.fromiter((len(x) // width + 1 for x in ids), dtype=np.int64, count=len(ids))
                    data, spots = framed([payload(k, x + end, width) for k, x in zip(keys, ids)])
                    sink.write(data)
                    first = tokens + np.cumsum(n) - n
                    place = at + spots[:-1]
                    out = [rows.column(0), pa.array([name] * len(n)), pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(place), pa.array(np.diff(spots)), pa.array(n), pa.array(first), pa.array((place // CHUNK).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(out, names=[x.split()[0] for x in _INDEX.split(", ")])
                    at, tokens = at + int(spots[-1]), tokens + int(n.sum())
        finally:
            if sink is not None:
                sink.close()

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())
    ordered = plain.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    return staged(ordered.mapInArrow(run, _INDEX), "records-index")


def read_records(index: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all records before it), n_tokens, ids_crc32 and, if asked for, ids; all but ``start`` from the files, whose checksums are verified.

    One row for each file and one for each chunk is shuffled; a chunk is read by one task.
    """
    totals = index.groupBy("file", "part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("file_start"))
    chunks = index.groupBy("file", "chunk").agg(F.min("at").alias("lo"), F.max(F.col("at") + F.col("size")).alias("hi"), F.min("first_token").alias("first"))
    held = index.agg(F.sum("size")).first()[0] or 0
    # One row for each write task.
    placed = chunks.join(F.broadcast(starts), "file").select("file", "lo", "hi", (F.col("file_start") + F.col("first")).alias("first"))
    placed = placed.repartition(max(1, -(-held // CHUNK)), "file", "lo")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        for batch in batches:
            for chunk in batch.to_pylist():
                with system.open_input_file(f"{path}/{chunk['file']}") as f:
                    found = [parsed(p) for p in unframed(f.read_at(chunk["hi"] - chunk["lo"], chunk["lo"]))]
                n = np.fromiter((len(ids) for _, ids in found), dtype=np.int64, count=len(found))
                crc = np.fromiter((zlib.crc32(ids.astype("<u4")) for _, ids in found), dtype=np.int64, count=len(found))
                out = [pa.array([k for k, _ in found], type=pa.int64()), pa.array(chunk["first"] + np.cumsum(n) - n), pa.array(n), pa.array(crc)]
                yield pa.RecordBatch.from_arrays(out + ([pa.array([ids.tolist() for _, ids in found], type=pa.list_(pa.int64()))] if with_ids else []), names=[x.split()[0] for x in schema.split(", ")])

    return placed.mapInArrow(run, schema)


def new_folder(docs: DataFrame) -> str:
    """A new folder for record files where all executors see it."""
    return f"{scratch_dir(docs.sparkSession)}/wordloom/records-{uuid.uuid4().hex}"


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1, folder: str | None = None, with_ids: bool = False) -> DataFrame:
    """Write ``docs`` as record files and read them back."""
    folder = folder or new_folder(docs)
    return read_records(write_records(docs, folder, tokenizer_path, end_id), folder, with_ids)
