"""Language-model scores from a probabilistic suffix tree over bytes, and a unigram base.

Text is A-Z lower-cased; tokens are its words and one end. The tree sees the words with one
blank between them and a line feed as the end, as bytes.

Training counts all windows of ``depth`` + 1 bytes in the training documents. From them come the counts of
each shorter context. A context stands for a state if it occurs often enough and its next-byte distribution diverges from that of the
context without its first byte by ``test`` nats over all its occurrences. "Often enough" grows with the 2/3 power of the ``n`` windows counted,
so the states each length may have grow with its cube root (n ** (1 / 3) / GROWTH at most): a larger corpus keeps more and rarer contexts. A state's distribution is smoothed
towards its parent's. With all prefixes of states added, reading a byte is one step of an automaton whose state is the longest
suffix; texts are read in pieces side by side, each warmed up with the ``depth`` bytes before it.

Base: counts of words with a relative frequency of ``head`` or more (1 / head words at most) are broadcast; the
other words go through a join.

Rows: null text is the end alone; repeated rows keep a row each; an empty table gives an
empty result; without training documents all counts are zero; ties don't arise, as a token has one longest state; very long texts are scored whole; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import staged, text_batches, utf8

DEPTH, TEST, SMOOTH = 5, 4.0, 1.0
#: A context needs GROWTH * (all windows) ** (2 / 3) occurrences, two at least.
GROWTH = 0.003
HEAD = 2e-6
PIECE = 512
#: Bytes of text read at once, and window counts a task holds before it hands them on.
SCAN, HELD = 2 << 20, 1 << 19
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def token_list(text: str | None) -> list[bytes]:
    return utf8(text).translate(_LOWER).split()


def _buffer(lines: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents with ``depth`` line feeds before each and the end behind; where each begins and its length with the end."""
    pad = b"\n" * depth
    raw = np.frombuffer(b"".join(pad + x + b"\n" for x in lines), dtype=np.uint8)
    size = np.fromiter((len(x) + 1 for x in lines), dtype=np.int64, count=len(lines))
    start = np.cumsum(size + depth) - size
    return raw, start, size


def _scored(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    mark = np.zeros(len(raw) + 1, dtype=np.int8)
    mark[start] += 1
    np.add.at(mark, start + size, -1)
    return np.cumsum(mark[:-1], dtype=np.int8).astype(bool)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    g, of = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    c = np.bincount(of, weights=np.concatenate([c for _, c in parts]), minlength=len(g)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(g), pa.array(c)], names=["g", "c"])


def window_counts(docs: DataFrame, depth: int) -> DataFrame:
    """g (the window's bytes, the first one highest), c. A task holds the windows of 2 MB of text and HELD counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for lo, hi in text_batches(batch, "text", SCAN):
                raw, start, size = _buffer([b" ".join(token_list(t)) for t in batch.slice(lo, hi - lo).column(0).to_pylist()], depth)
                g = np.zeros(len(raw) - depth, dtype=np.int64)
                for k in range(depth + 1):
                    g <<= 8
                    g |= raw[k : len(raw) - depth + k]
                parts.append(np.unique(g[_scored(raw, start, size)[depth:]], return_counts=True))
                if sum(len(g) for g, _ in parts) > HELD:
                    yield _summed(parts)
                    parts = []
        if parts:
            yield _summed(parts)

    return docs.select("text").mapInArrow(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


class Tree:
    """States of the tree, closed under prefixes and suffixes, as an automaton over the bytes seen."""

    def __init__(self, depth: int, nodes: dict[tuple[int, int], tuple[list[int], list[int]]], smooth: float = SMOOTH):
        self.depth = depth
        states = {(0, 0)}
        for d, c in nodes:
            for i in range(d):
                for j in range(i, d):
                    states.add((j - i + 1, c >> 8 * i & (1 << 8 * (j - i + 1)) - 1))
        order = sorted(states)
        seen = sorted({b for nexts, _ in nodes.values() for b in nexts})
        self.symbol = np.full(256, len(seen), dtype=np.int16)  # bytes never seen share the last column
        self.symbol[seen] = np.arange(len(seen))
        width, rare = len(seen) + 1, max(1, 256 - len(seen))
        at = {s: i for i, s in enumerate(order)}
        rows = np.zeros((len(order), width), dtype=np.float32)
        for i, (d, c) in enumerate(order):
            parent = np.full(width, 1 / 256) if d == 0 else rows[at[d - 1, c & (1 << 8 * (d - 1)) - 1]]
            if d == 0:
                parent[-1] = rare / 256
            rows[i] = parent
            if (d, c) in nodes:
                nexts, counts = nodes[d, c]
                own = np.zeros(width)
                own[self.symbol[nexts]] = counts
                rows[i] = (own + smooth * parent) / (own.sum() + smooth)
        rows[:, -1] /= rare
        self.log = np.log10(rows, out=rows)
        codes = np.array([d << 48 | c for d, c in order], dtype=np.int64)
        d, c = codes >> 48, codes & (1 << 48) - 1
        self.next = np.zeros((len(order), width), dtype=np.int32)
        for s, b in enumerate(seen):
            new, found = c << 8 | b, np.zeros(len(order), dtype=bool)
            for m in range(depth, 0, -1):
                code = m << 48 | new & (1 << 8 * m) - 1
                k = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                hit = ~found & (m <= d + 1) & (codes[k] == code)
                self.next[hit, s] = k[hit]
                found |= hit
        self.states = len(order)

    def score(self, lines: list[bytes]) -> np.ndarray:
        """log10 of the probability of each line and its end."""
        raw, start, size = _buffer(lines, self.depth)
        symbol = self.symbol[raw]
        pieces = -(-len(raw) // PIECE)
        wide = np.full(self.depth + pieces * PIECE, self.symbol[10], dtype=np.int16)
        wide[self.depth : self.depth + len(raw)] = symbol
        width = self.log.shape[1]
        flat_log, flat_next = self.log.ravel(), self.next.ravel()
        state = np.zeros(pieces, dtype=np.int64)
        first = np.arange(pieces) * PIECE
        out = np.empty((PIECE, pieces), dtype=np.float32)
        for t in range(PIECE + self.depth):
            cell = state * width + wide[first + t]
            if t >= self.depth:
                out[t - self.depth] = flat_log[cell]
            state = flat_next[cell]
        line = out.T.ravel()[: len(raw)].astype(np.float64)
        line[~_scored(raw, start, size)] = 0
        return np.add.reduceat(line, start) if len(start) else np.zeros(0)


def least_count(total: int) -> float:
    return max(2.0, GROWTH * total ** (2 / 3))


def grow(windows: DataFrame, depth: int = DEPTH, least: float | None = None, test: float = TEST) -> Tree:
    """The tree from window counts. At most depth + 1 times ``all windows / least`` contexts reach the driver."""
    total = windows.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    least = least_count(total) if least is None else least
    of = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d")
    mask = F.expr("shiftleft(1L, cast(8 * d as int)) - 1L")
    long = windows.select(F.shiftright("g", 8).alias("full"), (F.col("g").bitwiseAND(255)).cast("int").alias("next"), "c", of)
    long = long.select("d", F.col("full").bitwiseAND(mask).alias("ctx"), "next", "c").groupBy("d", "ctx", "next").agg(F.sum("c").alias("c"))
    frequent = long.groupBy("d", "ctx").agg(F.sum("c").alias("n"), F.collect_list(F.struct("next", "c")).alias("nexts")).where(F.col("n") >= least)
    frequent = staged(frequent, "contexts")
    flat = frequent.select("d", "ctx", "n", F.explode("nexts").alias("x")).select("d", "ctx", "n", "x.next", "x.c")
    parent = flat.select((F.col("d") + 1).alias("d"), F.col("ctx").alias("up"), "next", (F.col("c") / F.col("n")).alias("q"))
    up = F.col("ctx").bitwiseAND(F.expr("shiftleft(1L, cast(8 * (d - 1) as int)) - 1L"))
    gain = flat.where("d > 0").withColumn("up", up).join(parent, ["d", "up", "next"]).groupBy("d", "ctx").agg(F.sum(F.col("c") * F.log(F.col("c") / F.col("n") / F.col("q"))).alias("nats"))
    kept = frequent.join(gain.where(F.col("nats") >= test), ["d", "ctx"], "left_semi").unionByName(frequent.where("d = 0"))
    flat = kept.select("d", "ctx", F.col("nexts.next").alias("next"), F.col("nexts.c").alias("c")).toArrow()
    d, ctx, nexts, counts = (x.to_pylist() for x in flat.columns)
    nodes = dict(zip(zip(d, ctx), zip(nexts, counts)))
    return Tree(depth, nodes, SMOOTH)


def word_counts(docs: DataFrame) -> DataFrame:
    """w (the end is the empty word), c."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch, "text", SCAN):
                found: Counter[bytes] = Counter()
                texts = batch.slice(lo, hi - lo).column(0).to_pylist()
                for t in texts:
                    found.update(token_list(t))
                found[b""] = len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), type=pa.binary()), pa.array(list(found.values()), type=pa.int64())], names=["w", "c"])

    return docs.select("text").mapInArrow(run, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


def score(docs: DataFrame, held_out: F.Column | None = None, depth: int = DEPTH, least: float | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out``: a condition over doc_id; its rows are scored and not learned from.
    """
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    plain = plain.select("doc_id", "text", held_out.alias("held_out"))
    train = plain.where(~F.col("held_out"))
    counts = staged(word_counts(train), "words")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = totals["n"], totals["v"]
    frequent = counts.where(F.col("c") >= max(2.0, HEAD * n))
    head = frequent.toArrow()
    shared = docs.sparkSession.sparkContext.broadcast((dict(zip(head.column(0).to_pylist(), head.column(1).to_pylist())), grow(staged(window_counts(train, depth), "windows"), depth, least)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tree = shared.value
        row = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "w", "tf"]
        for batch in batches:
            for lo, hi in text_batches(batch, "text", SCAN):
                rows = batch.slice(lo, hi - lo)
                tokens = [token_list(t) for t in rows.column(1).to_pylist()]
                size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
                code: dict[bytes, int] = {}
                flat = np.array([code.setdefault(w, len(code)) for ts in tokens for w in ts], dtype=np.int64)
                words = list(code)
                c = np.array([known.get(w, -1) for w in [*words, b""]], dtype=np.float64)
                log = np.where(c >= 0, np.log10((np.maximum(c, 0) + 1) / (n + v + 1)), 0.0)
                doc = np.repeat(np.arange(len(tokens)), size)
                ok = c[flat] > 0 if len(flat) else np.zeros(0, dtype=bool)
                base = np.bincount(doc, weights=log[flat], minlength=len(tokens)) if len(flat) else np.zeros(len(tokens))
                seen = np.bincount(doc[ok], minlength=len(tokens))
                base, seen = base + np.log10((max(c[-1], 0) + 1) / (n + v + 1)), seen + (c[-1] > 0)
                ids = row + np.arange(len(tokens))
                row += len(tokens)
                lines = tree.score([b" ".join(ts) for ts in tokens])
                k = len(tokens)
                none = lambda kind, size=None: pa.nulls(k if size is None else size, kind)
                yield pa.RecordBatch.from_arrays([pa.array(ids), rows.column(0), rows.column(2), pa.array(size + 1), pa.array(seen), pa.array(base), pa.array(lines), none(pa.binary()), none(pa.int64())], names=names)
                rare = c[flat] < 0 if len(flat) else ok
                pair, tf = np.unique(doc[rare] * max(1, len(words)) + flat[rare], return_counts=True)
                m = len(pair)
                if m:
                    w = pa.array(words, type=pa.binary()).take(pa.array(pair % len(words)))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[pair // len(words)]), none(pa.int64(), m), none(pa.bool_(), m), none(pa.int64(), m), none(pa.int64(), m), none(pa.float64(), m), none(pa.float64(), m), w, pa.array(tf.astype(np.int64))], names=names)

    read = staged(plain.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, w binary, tf long"), "scores")
    rest = counts.where(F.col("c") < max(2.0, HEAD * n))
    rare = read.where("w is not null").select("row", "w", "tf").join(rest, "w", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    rare = rare.groupBy("row").agg(F.sum(F.col("tf") * F.log10((F.col("c") + 1) / F.lit(float(n + v + 1)))).alias("rare_base"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("rare_known"))
    out = read.where("w is null").drop("w", "tf").join(rare, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("rare_known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + zero("rare_base")).alias("base_score"), "score")
