"""Benchmark decontamination by template windows.

Tokens are words without outer punctuation. Numbers, units behind a number, and capitalised words inside a sentence become
typed placeholders; other words count in lower case. Windows of five template tokens, of which three or more are literal, are
joined by hash. Hits of one document and item that lie on one diagonal (the same shift) are held to
slot consistency: a slot value of the item must always meet the same value in the document and the
other way round, so a re-parameterised question counts and a chance mix of values doesn't.

What is a slot depends on case and some passages are slots alone, so plain windows go through the same join: five
lower-cased tokens each, whatever they are. An item is in a document if consistent diagonals cover ``threshold`` of its
windows of either kind (five words and 0.8).

The benchmark's hashes are broadcast as a filter only while there are at most ``FILTER_LIMIT`` of them (8 bytes each);
beyond that all windows go through the join. Either way the join and the counts are Spark's.

Rows: null or empty texts and items have no windows; an item shorter than a window is one window of its whole
length if it is three tokens or more, and else isn't searched; repeated rows and ties count once; very long texts are read whole; empty tables give an empty result; other columns are ignored, and passed on by
``clean``, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import keyed, text_batches, utf8

WINDOW, LITERALS, THRESHOLD, FILTER_LIMIT = 5, 3, 0.8, 1 << 21
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”‘’«»„…–—¿¡"
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?", re.A)
_AMOUNT = re.compile(r"([+-]?\d[\d.,]*)([^\W\d_]+|%)")
#: Fixed words that count as units behind a number.
UNITS = frozenset("mm cm m km g kg mg t l ml s sec second seconds min minute minutes h hour hours day days week weeks month months year years mile miles foot feet inch inches yard yards pound pounds ounce ounces dollar dollars euro euros cent cents percent degree degrees meter meters metre metres kilometer kilometers kilogram kilograms gram grams liter liters litre litres".split())
_LITERAL, _NUM, _NAME, _UNIT = 0, 1, 2, 3
_SLOT_HASH = np.array([0, 0x1111_1111_1111_1111, 0x2222_2222_2222_2222, 0x3333_3333_3333_3333], dtype=np.uint64)


def _word(raw: str) -> tuple[int, bool, bool, bool, bool]:
    """Hash of the lower-cased word, whether it's a number, looks like a name, is a unit; whether it ends a sentence."""
    core = raw.strip(_EDGE)
    low = core.lower()
    number = bool(core) and core[0] in "0123456789+-" and bool(_NUMBER.fullmatch(core) or _AMOUNT.fullmatch(core))
    name = len(core) > 1 and core[0].isupper() and core[1:].islower()
    return xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass"), 7) if core else 0, number, name, low in UNITS, raw.rstrip("\"')]}”’»")[-1:] in ".!?:;"


def template(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all tokens in a row: text number, kind, template hash and value hash."""
    code: dict[bytes, int] = {}
    flat: list[int] = []
    sizes, breaks = [], []
    for t in texts:
        n = 0
        for line in utf8(t).split(b"\n"):
            words = line.split()
            breaks.append(len(flat))
            flat.extend([code.setdefault(w, len(code)) for w in words])
            n += len(words)
        sizes.append(n)
    if not flat:
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),) * 2
    table = [_word(w.decode("utf-8", "surrogatepass")) for w in code]
    value, number, name, unit, stop = (np.array(c, dtype=k) for c, k in zip(zip(*table), (np.uint64, bool, bool, bool, bool)))
    ids = np.array(flat, dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    first = np.append(True, text[1:] != text[:-1])
    fresh = first | np.append(True, stop[ids][:-1])
    fresh[[b for b in breaks if b < len(ids)]] = True
    after_number = ~first & np.append(False, number[ids][:-1])
    kind = np.where(number[ids], _NUM, np.where(unit[ids] & after_number, _UNIT, np.where(name[ids] & ~fresh, _NAME, _LITERAL)))
    value = value[ids]
    full = value != 0  # tokens of punctuation alone don't count
    hashed = np.where(kind == _LITERAL, value, _SLOT_HASH[kind])
    return text[full], kind[full], hashed[full], value[full]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def windows(texts: list[str | None], width: int, known: np.ndarray | None = None):
    """Text number, position, hash, whether it's plain, and kinds/values of each template window with enough literals and each plain window."""
    text, kind, hashed, value = template(texts)
    n = len(text) - width + 1
    if n <= 0:
        return text[:0], text[:0], hashed[:0], np.zeros(0, dtype=bool), np.zeros((0, width), dtype=np.int64), np.zeros((0, width), dtype=np.uint64)
    whole = text[:n] == text[width - 1 :]
    literal = np.cumsum(np.append(0, kind == _LITERAL))
    found = []
    for tokens, ok, salt in ((hashed, whole & (literal[width : n + width] - literal[:n] >= min(LITERALS, width)), 0), (value, whole, 1 << 20)):
        h = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            h = h * np.uint64(0x100000001B3) + _mix(tokens[k : n + k])
        at = np.flatnonzero(ok)
        h = _mix(h[at]) + np.uint64(width + salt)
        if known is not None:
            k = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[k] == h if len(known) else np.zeros(len(h), dtype=bool)
            at, h = at[hit], h[hit]
        found.append((at, h))
    at, h = (np.concatenate(c) for c in zip(*found))
    plain = np.arange(len(at)) >= len(found[0][0])
    start = np.searchsorted(text, np.arange(text[-1] + 1))
    span = at[:, None] + np.arange(width)
    return text[at], at - start[text[at]], h, plain, np.where(plain[:, None], _LITERAL, kind[span]), value[span]


def window_table(texts: DataFrame, width: int, known: np.ndarray | None = None, short: bool = False) -> DataFrame:
    """id, pos, h, plain, kinds, vals; only hashes in ``known`` if given. ``short``: texts below the width give one window of their length."""
    shared = texts.sparkSession.sparkContext.broadcast(known)
    names = ["id", "pos", "h", "plain", "kinds", "vals"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for lo, hi in text_batches(batch, "text", 4 << 20):
                rows = batch.slice(lo, hi - lo)
                ids, page = rows.column(0), rows.column(1).to_pylist()
                for w in (range(LITERALS, width + 1) if short else [width]):
                    some = page
                    if short and w < width:
                        n = np.bincount(template(page)[0], minlength=len(page))
                        some = [t if c == w else None for t, c in zip(page, n)]
                    text, pos, h, plain, kinds, values = windows(some, w, known)
                    if len(h):
                        offsets = pa.array(np.arange(len(h) + 1, dtype=np.int32) * w)
                        slots = np.where(kinds == _LITERAL, 0, values.view(np.int64))
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(text)), pa.array(pos), pa.array(h.view(np.int64)), pa.array(plain), pa.ListArray.from_arrays(offsets, pa.array(kinds.ravel().astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(slots.ravel()))], names=names)

    return texts.mapInArrow(run, "id long, pos long, h long, plain boolean, kinds array<int>, vals array<long>")


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """doc_id, item_id, coverage, n_slots: items that a document holds, with the number of its slots that matched."""
    items = benchmark.select(F.col(item_key).cast("long").alias("id"), F.col(item_text).cast("string").alias("text")).where("id is not null")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("text is not null and id is not null")
    wanted = window_table(items, width, short=True).select(F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "h", "plain", "vals").withColumnRenamed("vals", "item_vals").distinct().persist()
    distinct = wanted.select("h").distinct()
    known = None
    if distinct.count() <= FILTER_LIMIT:
        known = np.sort(distinct.toArrow().column(0).to_numpy().view(np.uint64))
    widths = [r[0] for r in wanted.select(F.size("item_vals")).distinct().collect()] or [width]
    seen = None
    for w in sorted(widths):
        part = window_table(rows, w, known)
        seen = part if seen is None else seen.unionByName(part)
    hits = seen.select(F.col("id").alias("doc_id"), "pos", "h", "vals").join(wanted, "h")
    hits = hits.where(F.size("vals") == F.size("item_vals")).withColumn("shift", F.col("pos") - F.col("item_pos"))
    pairs = F.filter(F.arrays_zip("item_vals", "vals"), lambda x: x["item_vals"] != 0)
    line = hits.groupBy("doc_id", "item_id", "shift").agg(F.collect_set(F.struct("plain", "item_pos")).alias("at"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("slots"))
    one_to_one = (F.size(F.array_distinct(F.col("slots.item_vals"))) == F.size("slots")) & (F.size(F.array_distinct(F.col("slots.vals"))) == F.size("slots"))
    best = line.where(one_to_one).groupBy("doc_id", "item_id").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.max(F.size("slots")).alias("n_slots"))
    size = wanted.groupBy("item_id").agg(*(F.count_distinct(F.when(c, F.col("item_pos"))).alias(n) for c, n in ((F.col("plain"), "n_plain"), (~F.col("plain"), "n_template"))))
    share = F.greatest(F.expr("try_divide(size(filter(at, x -> x.plain)), n_plain)"), F.expr("try_divide(size(filter(at, x -> not x.plain)), n_template)"))
    return best.join(size, "item_id").withColumn("coverage", share).where(F.col("coverage") >= threshold).select("doc_id", "item_id", "coverage", "n_slots")


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each document that holds an item: doc_id, item_ids, coverage (the best), n_slots."""
    return matches(docs, benchmark, **options).groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage"), F.max("n_slots").alias("n_slots"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows that hold no item; each is decided by itself, whatever its id."""
    rows, row = keyed(docs)
    found = matches(rows, benchmark, key=row, **options).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(found, row, "left_anti").select(*docs.columns)
