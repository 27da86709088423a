"""Removal of repeated byte strings through suffix arrays.

Each string of ``LENGTH`` bytes picks an anchor: the first of the smallest hashes of ``GRAM``-byte grams in its first
``FRONT`` bytes. The choice depends on the string alone, so all its copies pick the same anchor at the same distance.
Strings of one document that pick one anchor are neighbours; together they are a context, ``d`` bytes to the
left of the anchor and up to ``LENGTH`` to the right.

1. A scan leaves one row for each context: a key (hash of the bytes that any string of it must hold right of the anchor), a hash of the
   whole context, and where it is. Keys that occur once are dropped.
2. Equal contexts are counted, map-side first. A context that occurs twice is repeated throughout.
3. Keys with several different contexts: one copy of each context is read. In a task, whole key groups
   are joined into one text; its suffix array (built by grouping, over blocks of bytes) orders the right sides and gives the
   lengths that neighbours share. For each distance d, strings whose right sides share LENGTH - d bytes and whose d bytes
   to the left are equal are repeated.
4. A key with more than ``HOT`` contexts isn't gathered: its strings are dealt and counted by two salts of one 64-bit hash instead.

Rows: null text counts as empty; copies of a row, also under the same doc_id, repeat each other; very long texts are read
in overlapping pieces; an empty table gives an empty result; other columns are ignored (``dedup_text`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import discarded, fresh, staged, text_batches, utf8
from wordloom.llm.grouping_sort import suffix_order

LENGTH, FRONT, GRAM = 200, 168, 24
CHOICES = FRONT - GRAM + 1  # distances an anchor may have
SURE = LENGTH - CHOICES + 1  # bytes right of the anchor that each string holds
BLOCK = 24
HOT = 20_000
SPAN = (1 << 20) - LENGTH - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for b in (_BASE, _INVERSE):
            steps = np.full(1 << 20, b, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def _mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    h = (h ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any substring of a text of at most 2^20 bytes."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _power_tables()
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start], salt)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def contexts(raw: np.ndarray, owner: np.ndarray):
    """key, whole, first string, number of strings and distance of the first one's anchor, for each context.

    ``owner``: which document each byte belongs to.
    """
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, dtype=np.uint64),) * 2 + (np.zeros(0, dtype=np.int64),) * 3
    hashes = Hashes(raw)
    at = np.arange(len(raw) - GRAM + 1)
    low = np.uint64((1 << 20) - 1)
    ranked = (hashes.of(at, at + GRAM) & ~low) | at.astype(np.uint64)
    anchor = (_sliding_min(ranked, CHOICES)[:n] & low).astype(np.int64)
    whole = owner[:n] == owner[LENGTH - 1 :]
    string = np.flatnonzero(whole)
    if not len(string):
        return (np.zeros(0, dtype=np.uint64),) * 2 + (np.zeros(0, dtype=np.int64),) * 3
    a = anchor[string]
    head = np.append(True, (a[1:] != a[:-1]) | (string[1:] != string[:-1] + 1))
    first = string[head]
    count = np.diff(np.append(np.flatnonzero(head), len(string)))
    a = a[head]
    key = hashes.of(a, a + SURE, 1)
    of_all = hashes.of(first, first + count - 1 + LENGTH, 2)
    of_all = _mix(of_all + (count * 1024 + (a - first)).astype(np.uint64) * np.uint64(_BASE), 3)
    return key, of_all, first, count, a - first


def _row_id() -> F.Column:
    return F.xxhash64("doc_id", "text")


def context_table(docs: DataFrame) -> DataFrame:
    """docs(row, text) -> key, whole, row, first, n, d."""
    names = ["key", "whole", "row", "first", "n", "d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch, "text", SPAN):
                rows = batch.slice(lo, hi - lo)
                texts = [utf8(t) for t in rows.column(1).to_pylist()]
                ids = rows.column(0).to_numpy()
                # Texts that together fit are hashed as one; a longer one comes in pieces that overlap.
                pieces, group, held = [], [], 0
                for k, t in enumerate(texts):
                    if len(t) < LENGTH:
                        continue
                    if held + len(t) > SPAN and group:
                        pieces.append(group)
                        group, held = [], 0
                    if len(t) <= SPAN:
                        group.append((k, 0, t))
                        held += len(t)
                    else:
                        step = SPAN - LENGTH + 1
                        pieces.extend([[(k, s, t[s : s + SPAN])] for s in range(0, len(t) - LENGTH + 1, step)])
                if group:
                    pieces.append(group)
                for group in pieces:
                    raw = np.frombuffer(b"".join(t for _, _, t in group), dtype=np.uint8)
                    sizes = np.fromiter((len(t) for _, _, t in group), dtype=np.int64, count=len(group))
                    owner = np.repeat(np.arange(len(group)), sizes)
                    begin = np.cumsum(sizes) - sizes - np.array([s for _, s, _ in group])
                    key, whole, first, n, d = contexts(raw, owner)
                    if len(key):
                        who = owner[first]
                        row = ids[np.array([k for k, _, _ in group])[who]]
                        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(row), pa.array((first - begin[who]).astype(np.int32)), pa.array(n.astype(np.int16)), pa.array(d.astype(np.int16))], names=names)

    return docs.mapInArrow(run, "key long, whole long, row long, first int, n short, d short")


def _ranks(rows: np.ndarray) -> np.ndarray:
    """Order-preserving numbers, from 2, of byte rows whose width is a multiple of 8."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    rank = np.zeros(len(words), dtype=np.int64)
    for k in range(words.shape[1]):
        _, own = np.unique(words[:, k], return_inverse=True)
        _, rank = np.unique(rank * (int(own.max(initial=0)) + 1) + own, return_inverse=True)
    return rank + 2


def repeated_strings(key: np.ndarray, n: np.ndarray, d: np.ndarray, data: list[bytes]) -> list[np.ndarray]:
    """For whole key groups of different contexts: which strings of each occur in another context."""
    m = len(key)
    right = np.zeros((m, LENGTH), dtype=np.uint8)
    left = np.zeros((m, CHOICES), dtype=np.uint8)  # column k: the byte k + 1 before the anchor
    length = np.zeros(m, dtype=np.int64)
    for i, b in enumerate(data):
        side = np.frombuffer(b, dtype=np.uint8)
        k = int(d[i])
        right[i, : len(b) - k], length[i] = side[k:], len(b) - k
        left[i, :k] = side[:k][::-1]
    # The text: for each context its key's number, blocks of its right side behind the bytes that the key stands for, and a separator.
    _, group = np.unique(key, return_inverse=True)
    blocks = -(-np.maximum(length - SURE, 0) // BLOCK)
    of = np.repeat(np.arange(m), blocks)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    wide = np.zeros((m, SURE + -(-(LENGTH - SURE) // BLOCK) * BLOCK), dtype=np.uint8)
    wide[:, :LENGTH] = right
    cells = wide[of[:, None], SURE + nth[:, None] * BLOCK + np.arange(BLOCK)] if len(of) else np.zeros((0, BLOCK), dtype=np.uint8)
    used = np.minimum(length[of] - SURE - nth * BLOCK, BLOCK)
    symbol = _ranks(cells) * (BLOCK + 1) + used  # a shorter block sorts before those it begins
    start = np.cumsum(blocks + 2) - (blocks + 2)
    text = np.ones(int((blocks + 2).sum()) + 1, dtype=np.int64)
    text[-1] = 0
    base = int(symbol.max(initial=1)) + 1
    text[start] = base + group
    text[np.repeat(start + 1, blocks) + nth] = symbol
    place = np.full(len(text), -1, dtype=np.int64)
    place[start] = np.arange(m)
    order = place[np.array(suffix_order(text.tolist()), dtype=np.int64)]
    order = order[order >= 0]
    # Bytes that neighbours share.
    same = right[order[1:]] == right[order[:-1]]
    shared = np.where(same.all(axis=1), LENGTH, same.argmin(axis=1)) if m > 1 else np.zeros(0, dtype=np.int64)
    shared = np.minimum(shared, np.minimum(length[order[1:]], length[order[:-1]]))
    shared[group[order[1:]] != group[order[:-1]]] = 0
    marks = [np.zeros(int(x), dtype=bool) for x in n]
    flat = np.zeros(int(n.sum()), dtype=bool)
    offset = np.cumsum(n.astype(np.int64)) - n
    before = np.zeros(m, dtype=np.uint64)
    low, high = (d - n + 1).astype(np.int64), d.astype(np.int64)
    for x in range(int(high.max(initial=-1)) + 1):
        if x:
            before = (before + left[:, x - 1] + np.uint64(1)) * np.uint64(_BASE)
        owns = (low[order] <= x) & (x <= high[order])
        if owns.sum() < 2:
            continue
        family = np.cumsum(np.append(0, shared < LENGTH - x))[owns]
        who = order[owns]
        code = _mix(before[who] + family.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 5)
        ranked = np.sort(code)
        twice = ranked[1:][ranked[1:] == ranked[:-1]]
        if len(twice):
            hit = who[np.isin(code, twice)]
            flat[offset[hit] + high[hit] - x] = True
    for i in range(m):
        marks[i] = flat[offset[i] : offset[i] + int(n[i])]
    return marks


def _runs(mark: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    return edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()


def _compared(groups: DataFrame) -> DataFrame:
    """groups(key, whole, n, d, data), each key in one task -> key, whole, skip, len: runs of repeated strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve(rows):
            key, whole, n, d, data = zip(*rows)
            out = []
            for k, w, mark in zip(key, whole, repeated_strings(np.array(key), np.array(n), np.array(d), list(data))):
                out.extend((k, w, s, x) for s, x in zip(*_runs(mark)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["key", "whole", "skip", "len"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= 8000 and row[0] != held[-1][0]:
                    yield from solve(held)
                    held = []
                held.append(row)
        if held:
            yield from solve(held)

    return groups.select("key", "whole", "n", "d", "data").repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, whole long, skip int, len int")


def _counted(groups: DataFrame) -> DataFrame:
    """As ``_compared``, for keys of any number of contexts: strings are dealt and counted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, whole, n, data in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                hashes = Hashes(np.frombuffer(data, dtype=np.uint8))
                at = np.arange(n)
                h = [pa.array(hashes.of(at, at + LENGTH, salt).view(np.int64)) for salt in (11, 12)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, key)), pa.array(np.full(n, whole)), pa.array(at.astype(np.int32)), *h], names=["key", "whole", "skip", "h", "i"])

    strings = staged(groups.select("key", "whole", "n", "d", "data").mapInArrow(run, "key long, whole long, skip int, h long, i long"), "strings")
    twice = strings.groupBy("h", "i").count().where("count > 1").select("h", "i")
    return strings.join(twice, ["h", "i"], "left_semi").select("key", "whole", "skip", F.lit(1).alias("len"))


def repeated_runs(docs: DataFrame) -> DataFrame:
    """docs(row, text) -> row, start, len: runs of starts of repeated strings in each text."""
    spark = docs.sparkSession
    every = staged(context_table(docs), "contexts")
    # A table of its own: beside an aggregate, the join couldn't split the rows of a very common passage.
    often = staged(every.groupBy("key").count().where("count > 1").select("key"), "often")
    table = staged(every.join(often, "key", "left_semi"), "repeated-keys")
    discarded(spark, every, often)
    place = F.min(F.struct("row", "first")).alias("p")
    equal = table.groupBy("key", "whole").agg(F.count("*").alias("times"), place, F.first("n").alias("n"), F.first("d").alias("d"))
    equal = staged(equal.select("key", "whole", "times", "p.row", "p.first", "n", "d"), "equal-contexts")
    several = equal.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    wanted = equal.join(several, "key")
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("key", "whole", "first", "n", "d", "m")).alias("parts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch, "text", 4 << 20):
                rows = []
                for text, parts in zip(*(c.to_pylist() for c in batch.slice(lo, hi - lo).columns)):
                    raw = utf8(text)
                    rows.extend((p["key"], p["whole"], p["n"], p["d"], p["m"], raw[p["first"] : p["first"] + p["n"] - 1 + LENGTH]) for p in parts)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int64(), pa.binary()))], names=["key", "whole", "n", "d", "m", "data"])

    # Copies of a row have the same id; one text is enough.
    texts = docs.join(lists.hint("shuffle_hash"), "row").select("text", "parts")
    groups = staged(texts.mapInArrow(cut, "key long, whole long, n short, d short, m long, data binary").dropDuplicates(["key", "whole"]), "context-bytes")
    mixed = _compared(groups.where(F.col("m") <= HOT)).unionByName(_counted(groups.where(F.col("m") > HOT)))
    alike = equal.where("times > 1").select("key", "whole", F.lit(0).alias("skip"), F.col("n").cast("int").alias("len"))
    once = equal.where("times = 1").select("key", "whole")
    found = alike.unionByName(mixed.join(once, ["key", "whole"], "left_semi"))
    return table.join(found, ["key", "whole"]).select("row", (F.col("first") + F.col("skip")).alias("start"), "len")


def covered(starts: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by strings that begin in the runs ``(start, len)``."""
    out: list[list[int]] = []
    for start, n in sorted(starts):
        end = min(size, start + n - 1 + LENGTH)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _with_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text, runs (null: nothing repeats)."""
    rows = docs.withColumn("row", _row_id())
    runs = repeated_runs(rows.select("row", "text")).distinct().groupBy("row").agg(F.collect_list(F.struct("start", "len")).alias("runs"))
    return rows.join(runs.hint("shuffle_hash"), "row", "left").drop("row")


def removal(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch, "text", 8 << 20):
                rows = batch.slice(lo, hi - lo)
                out = []
                for text, runs in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist()):
                    raw = utf8(text)
                    gone = covered([(r["start"], r["len"]) for r in runs or ()], len(raw))
                    kept, at = hashlib.sha256(), 0
                    for a, b in gone:
                        kept.update(raw[at:a])
                        at = b
                    kept.update(raw[at:])
                    out.append((len(raw), sum(b - a for a, b in gone), len(gone), kept.hexdigest()))
                n, removed, spans, digest = zip(*out)
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(c, type=pa.int64()) for c in (n, removed, spans)), pa.array(digest)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_runs(plain).select("doc_id", "text", "runs").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup_text(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the remaining text of each row; a character cut by a removed range goes with it. Other columns stay."""
    columns = docs.columns
    own, wanted, repeats = docs.schema[text], fresh(columns, "row_hash"), fresh(columns, "repeated_runs")
    rows = docs.withColumn(wanted, F.xxhash64(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    plain = rows.select(F.col(wanted).alias("row"), F.col(text).cast("string").alias("text"))
    runs = repeated_runs(plain).distinct().groupBy("row").agg(F.collect_list(F.struct("start", "len")).alias("runs")).toDF(wanted, repeats)
    joined = rows.join(runs.hint("shuffle_hash"), wanted, "left").drop(wanted)

    @F.pandas_udf("string")
    def remaining(texts, runs):  # noqa: ANN001, ANN202
        import pandas as pd

        out = []
        for t, r in zip(texts, runs):
            if t is None or r is None or not len(r):
                out.append(t)
                continue
            raw = utf8(t)
            parts, at = [], 0
            for a, b in covered([(x["start"], x["len"]) for x in r], len(raw)):
                parts.append(raw[at:a])
                at = b
            parts.append(raw[at:])
            out.append("".join(p.decode("utf-8", "ignore") for p in parts))
        return pd.Series(out, dtype=object)

    return joined.withColumn(text, remaining(F.col(own.name).cast("string"), F.col(repeats))).select(*columns)
