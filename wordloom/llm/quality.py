"""Quality rules with risk-controlled cutoffs.

Every text gets counts over its whole length. Rules compare one ratio each with a cutoff.
Labelled rows are split by a hash of their id into two halves. On the first, each rule and
stratum gets the cutoff that catches most bad rows, where a good row costs as much as
``GOOD_COST`` bad ones; between the last good and the next bad value it takes the middle.
On the second half (the holdout) the union of a stratum's first j rules is tested for
j = 1, 2, ...: the exact binomial p-value for "the union rejects more than ``alpha`` of the
good rows" must not exceed ``delta`` over the number of strata. The sequence stops at the first
test that fails (fixed-sequence testing needs no further correction inside a stratum; Bonferroni
covers the strata). So with probability 1 - delta no stratum loses over alpha of its good rows.

Rows: null text counts as no words; null strata form one stratum of their own, apart from empty ones; labels that are null
or belong to no document are left out; of several labels of a document the lowest counts, and a text with several documents
counts once, as good if one of them is; repeated documents, ids and null ids are judged row by row; rules with equal gain go by their order; very long
texts are counted whole; an empty document or label table gives no cutoffs, so only the base rule decides. A stratum with too few labelled rows gets
no cutoffs. ``judge`` ignores other columns, ``keep`` passes them on; names used inside are drawn so that they meet none of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm._shared import fresh, staged, text_batches, utf8

ALPHA, DELTA, GOOD_COST = 0.02, 0.05, 20
#: Candidate cutoffs for each rule and stratum: quantiles of its values on the first half.
CANDIDATES = 64
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_lines", "n_marks")
#: Rules reject a text whose ratio lies above the cutoff.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_upper / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(word_chars, 1)",
    "long_words": "word_chars / greatest(n_words, 1)",
}
_SPACE, _SYMBOLS, _UPPER, _DIGITS, _MARKS = b" \t\n\r\x0b\x0c", b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b"!?"


#: The stratum of rows without one; an empty text is a stratum of its own.
NO_STRATUM = "\x00"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    v = len(known)
    if v >= 1 << 20:
        _, pair = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)
        code = pair[:-1] * v + ids[2:]
    else:
        code = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    ordered = np.sort(code)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(code, twice)
    mark = np.zeros(n, dtype=bool)
    for k in range(3):
        mark[k : n - 2 + k] |= hit
    return int(mark.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    raw = utf8(text)
    words = raw.split()
    without = lambda drop: len(raw) - len(raw.translate(None, drop))
    seen: set[bytes] = set()
    dup = lines = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    return len(words), len(text or "") - without(_SPACE), without(_SYMBOLS), dup, repeated_words(words), without(_UPPER), without(_DIGITS), lines, without(_MARKS)


def _plain(docs: DataFrame, stratum: str, text: str, key: str) -> list[F.Column]:
    return [F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit(NO_STRATUM)).alias("stratum"), F.xxhash64(F.col(text).cast("string")).alias("text_id"), F.col(text).cast("string").alias("text")]


def _counts(rows: pa.RecordBatch) -> list[pa.Array]:
    return [pa.array(c) for c in np.array([text_counts(t) for t in rows.column("text").to_pylist()], dtype=np.int64).T]


def features(docs: DataFrame, stratum: str = "lang", text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, stratum, text_id (a hash of the text) and the counts of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch, "text", 16 << 20):
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("stratum"), rows.column("text_id"), *_counts(rows)], names=["doc_id", "stratum", "text_id", *COUNTS])

    return docs.select(*_plain(docs, stratum, text, key)).mapInArrow(run, "doc_id long, stratum string, text_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def counted_rows(docs: DataFrame, stratum: str = "lang", text: str = "text", key: str = "doc_id") -> tuple[DataFrame, str]:
    """The rows of ``docs`` with a struct of the columns of ``features``; and its name."""
    width, own_name = len(docs.columns), fresh(docs.columns, "quality_counts")
    schema = T.StructType([*docs.schema.fields, T.StructField(own_name, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("stratum", T.StringType()), T.StructField("text_id", T.LongType()), *(T.StructField(c, T.LongType()) for c in COUNTS)]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pa.RecordBatch.from_arrays(batch.columns[width:], names=["doc_id", "stratum", "text_id", "text"])
            for lo, hi in text_batches(plain, "text", 16 << 20):
                rows = plain.slice(lo, hi - lo)
                own = pa.StructArray.from_arrays([rows.column("doc_id"), rows.column("stratum"), rows.column("text_id"), *_counts(rows)], names=["doc_id", "stratum", "text_id", *COUNTS])
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[:width]), own], names=[*docs_columns, own_name])

    docs_columns = docs.columns
    more = [c.alias(fresh(docs_columns, f"quality_{k}")) for k, c in enumerate(_plain(docs, stratum, text, key))]
    return docs.select(*docs_columns, *more).mapInArrow(run, schema), own_name


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exactly up to rounding."""
    if k >= n:
        return 1.0
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(terms)
    return min(1.0, math.exp(top) * math.fsum(math.exp(t - top) for t in terms))


def _labelled(feats: DataFrame, labels: DataFrame, label: str, key: str) -> DataFrame:
    marked = labels.groupBy(F.col(key).cast("long").alias("doc_id")).agg(F.min(F.col(label).cast("int")).alias("good")).where("doc_id is not null and good is not null")
    rules = F.array(*(F.expr(e).cast("double") for e in RULES.values()))
    # Each text counts once and lies on one side of the split, however often it or its id occurs; one good label makes it good.
    texts = feats.where(~base_failed()).join(marked, "doc_id").groupBy("stratum", "text_id").agg(F.max(F.col("good") > 0).alias("good"), F.max(rules).alias("v"))
    return texts.select("stratum", "good", (F.pmod(F.xxhash64("text_id"), F.lit(2)) == 0).alias("holdout"), "v")


def select_cutoffs(feats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, label: str = "quality", key: str = "doc_id") -> dict[str, list[tuple[str, float]]]:
    """For each stratum the rules with their cutoffs that passed the tests, in order of use.

    Only aggregates come to the driver: at most strata x rules x CANDIDATES rows.
    """
    rows = staged(_labelled(feats, labels, label, key), "quality")
    names = list(RULES)
    long = rows.select("stratum", "good", "holdout", F.posexplode("v").alias("rule", "x"))
    fit = long.where("not holdout")
    grid = fit.groupBy("stratum", "rule").agg(F.percentile_approx("x", [i / CANDIDATES for i in range(CANDIDATES + 1)], 10_000).alias("c"), F.max(F.when(F.col("good"), F.col("x"))).alias("good_max"))
    grid = grid.select("stratum", "rule", F.array_sort(F.array_distinct(F.array_union("c", F.array_compact(F.array("good_max"))))).alias("c"))
    below = F.expr("size(filter(c, y -> y < x))").alias("bin")
    bins = fit.join(F.broadcast(grid), ["stratum", "rule"]).groupBy("stratum", "rule", "c", below).agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"), F.min("x").alias("low"))
    best: dict[str, list[tuple[float, int, float]]] = {}
    by: dict[tuple[str, int], list] = {}
    for r in bins.collect():
        by.setdefault((r["stratum"], r["rule"]), []).append(r)
    for (stratum, rule), found in sorted(by.items()):
        cuts, found = found[0]["c"], sorted(found, key=lambda r: r["bin"])
        choice = (0.0, 0.0)
        for k, cut in enumerate(cuts):
            above = [r for r in found if r["bin"] > k]
            gain = sum(r["b"] for r in above) - GOOD_COST * sum(r["g"] for r in above)
            if above and gain > choice[0]:
                choice = (gain, (cut + above[0]["low"]) / 2)
        if choice[0] > 0:
            best.setdefault(stratum, []).append((choice[0], rule, choice[1]))
    if not best:
        return {}
    plan = {s: sorted(v, key=lambda x: (-x[0], x[1])) for s, v in best.items()}
    first = F.lit(None).cast("int")
    for s, v in plan.items():
        case = F.coalesce(*(F.when(F.col("v")[rule] > cut, F.lit(j)) for j, (_, rule, cut) in enumerate(v)))
        first = F.when(F.col("stratum") == s, case).otherwise(first)
    held: dict[str, dict[int | None, int]] = {}
    for r in rows.where("holdout and good").groupBy("stratum", first.alias("first")).count().collect():
        held.setdefault(r["stratum"], {})[r["first"]] = r["count"]
    passed: dict[str, list[tuple[str, float]]] = {}
    for s, v in plan.items():
        n, k = sum(held.get(s, {}).values()), 0
        for j, (_, rule, cut) in enumerate(v):
            k += held.get(s, {}).get(j, 0)
            if n == 0 or binomial_cdf(k, n, alpha) > delta / len(plan):
                break
            passed.setdefault(s, []).append((names[rule], cut))
    return passed


def _failed_rule(cutoffs: dict[str, list[tuple[str, float]]]) -> F.Column:
    """The first rule that rejects, base included; over the columns of ``features``."""
    failed = F.lit(None).cast("string")
    for s, rules in cutoffs.items():
        case = F.coalesce(*(F.when(F.expr(RULES[name]) > cut, F.lit(name)) for name, cut in rules))
        failed = F.when(F.col("stratum") == s, case).otherwise(failed)
    return F.when(base_failed(), F.lit("base")).otherwise(failed)


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, stratum: str = "lang", text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, the counts, base_failed, kept and failed_rule (the first rule that rejects, base included)."""
    feats = staged(features(docs, stratum, text, key), "quality-counts")
    failed = _failed_rule(select_cutoffs(feats, labels, alpha, delta))
    out = feats.withColumn("base_failed", base_failed()).withColumn("failed_rule", failed)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("failed_rule").isNull().alias("kept"), "failed_rule")


def keep(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, stratum: str = "lang", text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps: each row carries its own counts, so ids may repeat or be null and no text is shuffled."""
    rows, counts = counted_rows(docs, stratum, text, key)
    counted = staged(rows, "quality-rows")
    own = counted.select(f"{counts}.*")
    failed = _failed_rule(select_cutoffs(own, labels, alpha, delta))
    return counted.select(F.struct(*docs.columns).alias("document"), f"{counts}.*").where(failed.isNull()).select("document.*")
