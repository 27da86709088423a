"""Alignment of two tokenizers over the same text.

One pass encodes each text by both tokenizers into a staged table of packed ids. From ids alone come the byte offsets where tokens end. For each document the
shorter list of ends drives a galloping search (doubling steps, then halving) into the longer one: ends found in both cut the tokens into groups, and the
differences of neighbouring ranks are the ranges of tokens that overlap. A second pass counts, for every pair of ids, the documents that link it: each task
adds up what it has read before anything is shuffled. Counts of the ``HEAD`` most frequent pairs at most (16 bytes each) travel to every worker, so that no
frequent pair is a join key; links of the other pairs are joined with the table of counts, and each document's sums are put together at the end.

Rows: texts that are null, empty, or not given back by the bytes of both tokenizers have no tokens: zeros and an empty hash. A repeated row, or a repeated or null
doc_id, is a document of its own. Ties for a pair's highest count all count. Very long texts are encoded whole. An empty table gives an empty result.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import staged, text_batches, utf8
from wordloom.llm.packing import Encoder, byte_letters
from wordloom.llm.word_encoder import StretchCache

LANE = 64
HEAD = 1 << 20
#: Different pairs a task holds before it passes them on.
HELD = 1 << 21
#: Both tokenizers begin a new token at one blank between two characters that aren't white space.
_CUT = re.compile(r" (?<=\S )(?=\S)")
_SPACE = "▁"


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of ``short`` the first place in ``long`` that is not below it; both rise, and ``long`` reaches as far as ``short``.

    The short list is cut into lanes that are searched side by side. Within a lane each search starts where the one before ended: steps double until they
    reach the value, then the last step is halved.
    """
    n, m = len(short), len(long)
    out = np.zeros(n, dtype=np.int64)
    if n == 0:
        return out
    lanes = np.arange(0, n, LANE)
    at = np.searchsorted(long, short[lanes])
    out[lanes] = at
    for k in range(1, min(LANE, n)):
        i = lanes + k
        if i[-1] >= n:
            lanes, at, i = lanes[:-1], at[:-1], i[:-1]
        value = short[i]
        step = np.ones(len(i), dtype=np.int64)
        low = at.copy()  # all before ``low`` is below the value
        open_ = np.flatnonzero(long[at] < value)
        low[open_] += 1
        while len(open_):
            probe = np.minimum(at[open_] + step[open_], m - 1)
            still = long[probe] < value[open_]
            open_ = open_[still]
            low[open_] = probe[still] + 1
            step[open_] *= 2
        high = np.minimum(at + step, m - 1)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            below = long[middle] < value[open_]
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
        out[i] = at = low
    return out


class Pairing:
    """Both tokenizers, and the byte length of each of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.first = Encoder(path_a)
        if self.first.tok is None:
            from tokenizers import Tokenizer

            vocabulary = Tokenizer.from_file(path_a).get_vocab()
        else:
            vocabulary = self.first.tok.get_vocab()
        letters = byte_letters()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for word, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        sp = self.second = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        self.length_a, self.length_b = (np.fromiter(map(len, t), dtype=np.int64, count=len(t)) for t in (self.bytes_a, self.bytes_b))
        self.kind_a, self.kind_b = (f"<u{2 if n <= 1 << 16 else 4}" for n in (self.size_a, self.size_b))
        # Texts may be cut at single blanks if no piece runs over one and the text isn't rewritten first.
        self.cuts = self.first.fast is not None and not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces) and b"\x0a\x08identity" in sp.serialized_model_proto()
        self.cache_a = StretchCache(self._ids_a, int(self.kind_a[2]))
        self.cache_b = StretchCache(self._ids_b, int(self.kind_b[2]))

    def _ids_a(self, texts: list[str]) -> list[np.ndarray]:
        return self.first.encode([" " + t for t in texts])

    def _ids_b(self, texts: list[str]) -> list[list[int]]:
        return self.second.encode(texts, num_threads=1)

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Packed ids of each text by both; both empty where a text has no tokens."""
        stretches = [_CUT.split(t) if self.cuts else [t] for t in map(lambda t: t or "", texts)]
        a, b = self.cache_a.packed(stretches), self.cache_b.packed(stretches)
        for i, t in enumerate(texts):
            want = b" " + utf8(t)
            if not t or b"".join(map(self.bytes_a.__getitem__, np.frombuffer(a[i], self.kind_a).tolist())) != want or b"".join(map(self.bytes_b.__getitem__, np.frombuffer(b[i], self.kind_b).tolist())) != want:
                a[i] = b[i] = b""
        return a, b


@lru_cache(maxsize=1)
def worker_pairing(path_a: str, path_b: str) -> Pairing:
    return Pairing(path_a, path_b)


class Alignment:
    """Groups and links of several documents, given their ids by both tokenizers."""

    def __init__(self, a: list[bytes], b: list[bytes], pair: Pairing):
        self.n_a = np.fromiter(map(len, a), dtype=np.int64, count=len(a)) // int(pair.kind_a[2])
        self.n_b = np.fromiter(map(len, b), dtype=np.int64, count=len(b)) // int(pair.kind_b[2])
        self.a, self.b = (np.frombuffer(b"".join(x), dtype=k).astype(np.int64) for x, k in ((a, pair.kind_a), (b, pair.kind_b)))
        end_a, end_b = np.cumsum(pair.length_a[self.a]), np.cumsum(pair.length_b[self.b])
        docs, a_drives = np.arange(len(a)), self.n_a <= self.n_b
        doc_a, doc_b = np.repeat(docs, self.n_a), np.repeat(docs, self.n_b)
        self.last_a, self.last_b = np.zeros(len(self.a), dtype=bool), np.zeros(len(self.b), dtype=bool)
        left, right = [], []
        for drives, ids, other in ((a_drives, (doc_a, end_a, self.last_a), (doc_b, end_b, self.last_b)), (~a_drives, (doc_b, end_b, self.last_b), (doc_a, end_a, self.last_a))):
            short_at, long_at = np.flatnonzero(drives[ids[0]]), np.flatnonzero(drives[other[0]])
            short, long = ids[1][short_at], other[1][long_at]
            rank = gallop(short, long)
            common = long[rank] == short if len(short) else np.zeros(0, dtype=bool)
            ids[2][short_at[common]] = True
            other[2][long_at[rank[common]]] = True
            first = np.append(0, rank[:-1] + common[:-1])[: len(short)]
            count = rank - first + 1
            driver = np.repeat(short_at, count)
            met = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
            pairs = (driver, long_at[met]) if drives is a_drives else (long_at[met], driver)
            left.append(pairs[0])
            right.append(pairs[1])
        #: The linked tokens, by their places in ``a`` and ``b``; and the document and the id pair of each link.
        self.left, self.right = np.concatenate(left), np.concatenate(right)
        self.link_doc = doc_a[self.left]
        self.pair = self.a[self.left] * pair.size_b + self.b[self.right]
        self.n_groups = np.bincount(doc_a[self.last_a], minlength=len(a))
        self.n_links = np.bincount(self.link_doc, minlength=len(a))

    def group_hashes(self) -> list[str]:
        """SHA-256 of each document's ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        group_a, group_b = (np.cumsum(x) - x for x in (self.last_a, self.last_b))
        b_before, a_before = np.bincount(group_b, minlength=1), np.bincount(group_a, minlength=1)
        place_a = np.arange(len(self.a)) + (np.cumsum(b_before) - b_before)[group_a]
        place_b = np.arange(len(self.b)) + np.cumsum(a_before)[group_b]
        ids = np.zeros(len(self.a) + len(self.b), dtype=np.int64)
        mark = np.full(len(ids), ord(","), dtype=np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        mark[place_a[self.last_a]], mark[place_b[self.last_b]] = ord("|"), ord(";")
        digits = np.ones(len(ids), dtype=np.int64)
        width = len(str(int(ids.max(initial=0))))
        for k in range(1, width):
            digits += ids >= 10**k
        cells = np.empty((len(ids), width + 1), dtype=np.uint8)
        for k in range(width):
            cells[:, k] = ord("0") + ids // 10 ** np.maximum(digits - 1 - k, 0) % 10
        cells[np.arange(len(ids)), digits] = mark
        flat = cells[np.arange(width + 1)[None, :] <= digits[:, None]].tobytes()
        stop = np.append(0, np.cumsum(digits + 1))[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        return [hashlib.sha256(flat[lo : hi - 1]).hexdigest() if hi > lo else "" for lo, hi in zip(stop, stop[1:])]


def _binaries(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def encoded(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, a, b (packed ids) and a number for each row; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = worker_pairing(path_a, path_b)
        for batch in batches:
            for lo, hi in text_batches(batch, "text", 2 << 20):
                rows = batch.slice(lo, hi - lo)
                a, b = pair.encode(rows.column(1).to_pylist())
                found = Alignment(a, b, pair)
                out = [rows.column(0), *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array(found.group_hashes(), type=pa.string()), pa.array(a, type=pa.binary()), pa.array(b, type=pa.binary())]
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b"])

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = plain.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a binary, b binary")
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "aligned", "zstd")


def pair_counts(rows: DataFrame, path_a: str, path_b: str, held: int = HELD) -> DataFrame:
    """pair, n (documents that link it), best (whether no pair of its first id has more); staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, keys, times, waiting = worker_pairing(path_a, path_b), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), []
        every = pair.size_a * pair.size_b

        def merged() -> tuple[np.ndarray, np.ndarray]:
            flat, where = np.unique(np.concatenate([keys, *waiting]), return_inverse=True)
            added = np.bincount(where, weights=np.concatenate([times, np.ones(len(where) - len(times))]), minlength=len(flat)) if len(where) else np.zeros(0)
            return flat, added.astype(np.int64)

        for batch in batches:
            for lo, hi in text_batches(batch, "a", 1 << 20):
                part = batch.slice(lo, hi - lo)
                found = Alignment(_binaries(part, "a"), _binaries(part, "b"), pair)
                waiting.append(np.unique(found.link_doc * every + found.pair) % every)
                if sum(map(len, waiting)) > held:
                    keys, times = merged()
                    waiting = []
                    if len(keys) > held:
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], names=["pair", "n"])
                        keys, times = keys[:0], times[:0]
        keys, times = merged()
        for at in range(0, len(keys), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + (1 << 18)]), pa.array(times[at : at + (1 << 18)])], names=["pair", "n"])

    size_b = Pairing(path_a, path_b).size_b
    counts = staged(rows.select("a", "b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts", "zstd")
    first = F.floor(F.col("pair") / F.lit(size_b)).cast("int")
    # One row for each id of the first tokenizer.
    most = counts.groupBy(first.alias("first")).agg(F.max("n").alias("most"))
    return counts.withColumn("first", first).join(F.broadcast(most), "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent(counts: DataFrame, limit: int = HEAD) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """A count that at most ``limit`` pairs reach, and those pairs in order with their counts and marks."""
    band = F.floor(F.log2("n") * 4).cast("int")
    sizes = {r["band"]: r["count"] for r in counts.groupBy(band.alias("band")).count().collect()}
    least, room = None, limit
    for b in sorted(sizes, reverse=True):
        if sizes[b] > room:
            break
        least, room = b, room - sizes[b]
    head = counts.withColumn("band", band).where(F.col("band") >= (least if least is not None else 1 << 20)).select("pair", "n", "best").toArrow()
    pair, n, best = (head.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    return (least if least is not None else 1 << 20), pair[order], n[order], best[order].astype(bool)


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id", head: int = HEAD, held: int = HELD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document."""
    spark = docs.sparkSession
    rows = encoded(docs, path_a, path_b, text, key)
    counts = staged(pair_counts(rows, path_a, path_b, held), "pair-marks", "zstd")
    least, *table = frequent(counts, head)
    sent = spark.sparkContext.broadcast(table)
    kept = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row")
    kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, row long, n_best long, count_sum long, rare array<struct<pair: long, links: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, (known, n, best) = worker_pairing(path_a, path_b), sent.value
        every = pair.size_a * pair.size_b
        for batch in batches:
            for lo, hi in text_batches(batch, "a", 1 << 20):
                part = batch.slice(lo, hi - lo)
                found = Alignment(_binaries(part, "a"), _binaries(part, "b"), pair)
                where, links = np.unique(found.link_doc * every + found.pair, return_counts=True)
                doc, key_ = where // every, where % every
                spot = np.minimum(np.searchsorted(known, key_), max(len(known) - 1, 0))
                hit = known[spot] == key_ if len(known) else np.zeros(len(key_), dtype=bool)
                sums, bests = np.zeros(len(part), dtype=np.int64), np.zeros(len(part), dtype=np.int64)
                if hit.any():
                    np.add.at(sums, doc[hit], n[spot[hit]] * links[hit])
                    np.add.at(bests, doc[hit], best[spot[hit]] * links[hit])
                stops = np.append(0, np.cumsum(np.bincount(doc[~hit], minlength=len(part)))).astype(np.int32)
                rare = pa.StructArray.from_arrays([pa.array(key_[~hit]), pa.array(links[~hit].astype(np.int64))], names=["pair", "links"])
                out = [*(part.column(part.schema.get_field_index(c)) for c in kept), pa.array(bests), pa.array(sums), pa.ListArray.from_arrays(pa.array(stops), rare)]
                yield pa.RecordBatch.from_arrays(out, names=[*kept, "n_best", "count_sum", "rare"])

    partial = staged(rows.mapInArrow(run, kinds), "aligned-sums", "zstd")
    few = counts.where(F.floor(F.log2("n") * 4) < least)
    rest = partial.select("row", F.explode("rare").alias("x")).select("row", "x.pair", "x.links").join(few, "pair")
    rest = rest.groupBy("row").agg(F.sum(F.col("n") * F.col("links")).alias("rest_sum"), F.sum(F.when(F.col("best"), F.col("links"))).alias("rest_best"))
    out = partial.drop("rare").join(rest, "row", "left")
    more = lambda c, d: (F.col(c) + F.coalesce(d, F.lit(0))).alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", more("n_best", "rest_best"), more("count_sum", "rest_sum"), "groups_sha256")
