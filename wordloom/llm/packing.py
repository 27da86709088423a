"""Packing: concatenate all documents and cut the stream into fixed windows.

Two passes. The first tokenizes each document once, in the partition that holds it,
and keeps a running token offset within the partition; the ids go to a shared table.
The totals of the partitions (one row for each task) give every partition its place in
the global stream by a prefix sum. The second pass reads the ids, adds the two
offsets and cuts each document at window borders. Nothing is shuffled but the totals.

Rows: a null or empty text is its end id alone. Repeated rows, and rows with one id or none, are packed once each, in the order of the input's rows, which
is also the order of ties. Very long texts are encoded whole and cut over as many windows as they fill; a run of ``BLANKS`` white-space characters or more sends
its text to the slower library, with the same ids. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm._shared import staged, text_batches

WINDOW = 1024
#: Runs of white space from which a text goes to the ``tokenizers`` library.
BLANKS = 20_000
_LONG_BLANK = re.compile(rf"\s{{{BLANKS}}}")
#: Fixed value: how the byte-level pre-splitter cuts a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file. Strings of special tokens in a text are ordinary text, as the files' folder advises.

    A plain byte-level BPE file whose ids follow its merges is run by ``tiktoken``, which gives the same ids in less time; any other by ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.tok = path, None
        self.fast = self._as_ranks(spec)
        if self.fast is None:
            self._library()

    def _library(self):  # noqa: ANN202
        if self.tok is None:
            from tokenizers import Tokenizer

            self.tok = Tokenizer.from_file(self.path)
            self.tok.encode_special_tokens = True
        return self.tok

    @staticmethod
    def _as_ranks(spec: dict):  # noqa: ANN205
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            return None
        if not all(t.get("special") for t in spec.get("added_tokens") or ()):
            return None
        letters, vocabulary = byte_letters(), model["vocab"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if any(vocabulary.get(w) != 256 + i for i, w in enumerate(merged)) or any(vocabulary.get(c, 256) > 255 for c in letters):
            return None
        import tiktoken

        ranks = {bytes(letters[c] for c in w): vocabulary[w] for w in [*letters, *merged]}
        return tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, unsigned, four bytes each."""
        if self.fast is not None:
            # The fast splitter's stack doesn't hold very long runs of white space.
            return [self.fast.encode_to_numpy(t, disallowed_special=()) if len(t) < BLANKS or not _LONG_BLANK.search(t) else np.asarray(self._library().encode(t, add_special_tokens=False).ids, dtype="<u4") for t in texts]
        return [np.asarray(e.ids, dtype="<u4") for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def worker_encoder(path: str) -> Encoder:
    """One encoder for each Python worker, which serves many tasks."""
    return Encoder(path)


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, part, local_start, n_tokens, ids (little-endian, the end id last; two bytes an id where all of a batch fit, else four)."""
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path)
        part = TaskContext.get().partitionId()
        at = 0
        for batch in batches:
            for lo, hi in text_batches(batch, "text"):
                rows = batch.slice(lo, hi - lo)
                ids = encoder.encode([t or "" for t in rows.column(1).to_pylist()])
                n = np.fromiter((len(x) + 1 for x in ids), dtype=np.int64, count=len(ids))
                stop = np.cumsum(n)
                start = at + stop - n
                at += int(stop[-1])
                flat = np.concatenate([y for x in ids for y in (x, end)])
                width = 2 if flat.max() < 1 << 16 else 4
                flat = flat.astype(f"<u{width}", copy=False)
                held = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, width * stop).astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(start), pa.array(n), held], names=["doc_id", "part", "local_start", "n_tokens", "ids"])

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, part int, local_start long, n_tokens long, ids binary")


def partition_offsets(tokens: DataFrame) -> DataFrame:
    """part, part_start: the exclusive prefix sum over the totals of the partitions (one row for each task)."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = 0, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document that lies in one window.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, first_piece, last_piece
    (the boundary record: whether the document begins or ends in this piece), and with
    ``with_ids`` the ids of the piece.
    """
    tokens = staged(tokenized(docs, tokenizer_path, end_id, text, key), "packing")
    placed = tokens.join(F.broadcast(partition_offsets(tokens)), "part").select("doc_id", (F.col("part_start") + F.col("local_start")).alias("begin"), "n_tokens", "ids")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, first_piece boolean, last_piece boolean" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch, "ids", 8 << 20):
                rows = batch.slice(lo, hi - lo)
                begin, n = (rows.column(i).to_numpy() for i in (1, 2))
                first, last = begin // window, (begin + n - 1) // window
                count = last - first + 1
                row = np.repeat(np.arange(len(n)), count)
                sequence = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
                left = np.maximum(sequence * window, begin[row])
                right = np.minimum((sequence + 1) * window, begin[row] + n[row])
                start, length = left - begin[row], right - left
                wide = [np.frombuffer(x, dtype=f"<u{len(x) // m}").astype("<u4", copy=False) for x, m in zip(rows.column(3).to_pylist(), n.tolist())]
                pieces = [wide[r][s : s + m] for r, s, m in zip(row.tolist(), start.tolist(), length.tolist())]
                crc = np.fromiter((zlib.crc32(p) for p in pieces), dtype=np.int64, count=len(pieces))
                out = [rows.column(0).take(pa.array(row)), start, length, crc, n[row], sequence, left - sequence * window, start == 0, start + length == n[row]]
                arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in out] + ([pa.array([p.tolist() for p in pieces], type=pa.list_(pa.int32()))] if with_ids else [])
                yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in schema.split(", ")])

    return placed.mapInArrow(cut, schema)
