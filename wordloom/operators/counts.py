"""Corpus counts and list quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions import text as X
from wordloom.sources.writers import settled
from wordloom.sources.readers import corpus_tokens


def word_counts(docs: DataFrame) -> DataFrame:
    """A1: lang, word, cnt. Partial sums before the one shuffle."""
    return corpus_tokens(docs).groupBy("lang", "word").agg(F.count("*").alias("cnt"))


def vocabulary(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """A1 with spelling evidence, in one pass: lang, word, cnt, spread (in two documents or more)."""
    return corpus_tokens(docs, keep=(key,)).groupBy("lang", "word").agg(F.count("*").alias("cnt"), F.coalesce(F.min(key) < F.max(key), F.lit(False)).alias("spread"))


def with_zipf(counts: DataFrame) -> DataFrame:
    """F29 for each (lang, word); totals are one row for each language."""
    totals = counts.groupBy("lang").agg(F.sum("cnt").alias("total"))
    return counts.join(totals, "lang").withColumn("zipf", X.zipf(F.col("cnt"), F.col("total"))).drop("total")


def tagged_counts(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A2: frequency by form, and by form and lemma (lower case)."""
    rows = tagged.select(F.lower("form").alias("form"), F.lower("lemma").alias("lemma"), "frequency")
    return rows.groupBy("form").agg(F.sum("frequency").alias("cnt")), rows.groupBy("form", "lemma").agg(F.sum("frequency").alias("cnt"))


def percentiles(df: DataFrame, column: str, points: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95), by: list[str] = (), digits: int = 6) -> DataFrame:
    """Exact, by linear interpolation."""
    exact = F.percentile(column, F.array(*map(F.lit, points)))
    out = df.groupBy(*by).agg(F.count(column).alias("n"), exact.alias("p"))
    return out.select(*by, "n", *(F.round(F.col("p")[i], digits).alias(f"p{round(100 * q)}") for i, q in enumerate(points)))


def seen_counts(modules: DataFrame, counts: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Module, surface, lemma with their corpus counts; a missing pair count stays NULL."""
    rows = modules.withColumn("surface_key", F.lower("surface"))
    rows = rows.join(counts.select(F.col("form").alias("surface_key"), F.col("cnt").alias("surface_count")), "surface_key", "left").withColumn("surface_count", F.coalesce("surface_count", F.lit(0)))
    if pairs is not None:
        p = pairs.select(F.col("form").alias("surface_key"), F.col("lemma").alias("lemma_key"), F.col("cnt").alias("pair_count"))
        rows = rows.withColumn("lemma_key", F.lower("lemma")).join(p, ["surface_key", "lemma_key"], "left").drop("lemma_key")
    return rows.withColumn("seen", F.col("surface_count") > 0)


def seen_summary(rows: DataFrame) -> DataFrame:
    """A13"""
    return rows.groupBy("module").agg(F.count_if("seen").alias("n_seen"), F.count_if(~F.col("seen")).alias("n_unseen"))


def list_quality(words: DataFrame, column: str = "surface", by: list[str] = ()) -> DataFrame:
    """Entries, unique keys, duplicates."""
    return words.groupBy(*by).agg(F.count(column).alias("entries"), F.count_distinct(F.lower(column)).alias("unique_keys")).withColumn("duplicates", F.col("entries") - F.col("unique_keys"))


def source_profile(lines: DataFrame, width: int, count_field: int, sep: str = "\t", least_rows: int = 0) -> DataFrame:
    """One pass over raw lines; every kind of violation is counted."""
    v, cells = F.col("value"), F.split("value", sep, -1)
    empty, comment = F.trim(v) == "", F.ltrim(v).startswith("#")
    data = ~empty & ~comment
    raw = F.get(cells, F.lit(count_field))
    n = raw.try_cast("long")
    fits = data & (F.size(cells) == width)
    out = lines.agg(
        F.count("*").alias("lines"),
        F.count_if(empty).alias("empty_rows"),
        F.count_if(comment).alias("comment_rows"),
        F.count_if(data).alias("data_rows"),
        F.count_if(data & (F.size(cells) != width)).alias("wrong_width"),
        F.count_if(data & v.contains("�")).alias("not_utf8"),
        F.count_if(fits & n.isNull()).alias("not_integer"),
        F.count_if(fits & n.isNull() & raw.rlike("(?i)^(freq|count)")).alias("header_like"),
        F.count_if(fits & (n <= 0)).alias("not_positive"),
        F.coalesce(F.sum(F.when(fits & (n > 0), n)), F.lit(0)).alias("frequency_sum"),
    )
    return out.withColumn("enough_rows", F.col("data_rows") >= least_rows)


def unigrams(ranked: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of a ranked list."""
    return ranked.orderBy("rank").limit(n)


#: Tasks to which ``spread`` deals what one task would read.
PIECES = 8


def spread(docs: DataFrame, key: str = "doc_id", pieces: int = PIECES) -> DataFrame:
    """The same rows in ``pieces`` times as many tasks as read them.

    Nearly each pair of words is new to its task, so a task's partial counts grow with what it reads: those of one file split outgrow a task's memory and are
    sorted on disk, those of a piece of it are not. The rows are dealt by a key, as dealing them in turn would sort them first.
    """
    return docs.repartition(pieces * docs.rdd.getNumPartitions(), key)


def pair_counts(docs: DataFrame, text: str = "text", by: list[str] = ("lang",)) -> DataFrame:
    """previous, current, cnt: neighbouring words."""
    n = F.greatest(F.size("w") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("w", F.lit(1), n).alias("previous"), F.slice("w", F.lit(2), n).alias("current"))
    # The words are a column of their own, so that a text is split once and not for each mention.
    mentions = docs.select(*by, X.words(F.col(text)).alias("w")).select(*by, F.explode(pairs).alias("p"))
    # Words are the first keys: a count that outgrows its memory sorts by them, and the first eight bytes of the first key, which settle most comparisons, are nearly one value in a language.
    return mentions.groupBy("p.previous", "p.current", *by).agg(F.count("*").alias("cnt")).select(*by, "previous", "current", "cnt")


def bigrams(docs: DataFrame, text: str = "text", by: list[str] = ("lang",)) -> DataFrame:
    """Previous, current, cnt and a weight from 0 to 1000 relative to the commonest."""
    counted = pair_counts(docs, text, by)
    # One row for each language: a join by it would deal all pairs to as many tasks as there are languages.
    most = F.broadcast(counted.groupBy(*by).agg(F.max("cnt").alias("most")))
    return (counted.join(most, list(by)) if by else counted.crossJoin(most)).withColumn("weight", F.floor(F.lit(1000) * F.col("cnt") / F.col("most")).cast("int")).drop("most")


def top_next(pairs: DataFrame, k: int, by: list[str] = ("lang",)) -> DataFrame:
    """The ``k`` likeliest next words."""
    # The word is the first key, as in ``pair_counts``.
    w = Window.partitionBy("previous", *by).orderBy(F.desc("cnt"), "current")
    return pairs.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k)


def prefix_completion(entries: DataFrame, prefixes: DataFrame, k: int = 3, indexed: int = 3) -> DataFrame:
    """entries(word) that begin with each prefix: shorter ones first, then by spelling."""
    index = entries.select("word", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(indexed), F.length("word"))), lambda i: F.substring(F.col("word"), F.lit(1), i))).alias("head")).where("word <> ''")
    hit = prefixes.withColumn("head", F.substring("prefix", 1, indexed)).join(index, "head").where(F.col("word").startswith(F.col("prefix")))
    w = Window.partitionBy("prefix").orderBy(F.length("word"), "word")
    return hit.select("prefix", "word").distinct().withColumn("position", F.row_number().over(w)).where(F.col("position") <= k)


def correction_gate(corrections: DataFrame, accepted: DataFrame) -> DataFrame:
    """Targets with a word that isn't accepted, and wrong sides that are."""
    words = accepted.select(F.lower("word").alias("word")).distinct()
    parts = corrections.select("wrong", "canonical", F.explode(F.split(F.lower("canonical"), " ")).alias("word"))
    bad = parts.join(words, "word", "left_anti").select("wrong", "canonical", F.lit("unknown-target").alias("error"))
    known = corrections.withColumn("word", F.lower("wrong")).join(words, "word", "left_semi").select("wrong", "canonical", F.lit("wrong-side-accepted").alias("error"))
    return bad.unionByName(known).distinct()


#: Corrections that travel as one literal map; more of them are joined.
MAPPED = 2_000


def apply_corrections(docs: DataFrame, corrections: DataFrame, text: str = "text", key: str = "doc_id", mapped: int = MAPPED) -> DataFrame:
    """The text with corrected words; blanks stay as they are. A wrong word with several targets takes the smallest.

    A reviewed list is short and becomes a map inside one expression. A longer one is joined to the distinct words of the texts, and each text gets a map of
    its own corrections, so nothing unbounded reaches the driver or one key; rows are told apart by a number of their own, so keys may repeat.
    """
    table = corrections.groupBy("wrong").agg(F.min("canonical").alias("canonical"))
    some = table.limit(mapped + 1).collect()
    tokens = F.split(F.col(text), r"(?<=\s)|(?=\s)")

    def applied(rows: DataFrame, pairs: Column) -> DataFrame:
        hit = lambda t: F.try_element_at(pairs, F.lower(t))
        return rows.select(key, F.array_join(F.transform(tokens, lambda t: F.coalesce(hit(t), t)), "").alias("corrected"), F.size(F.filter(tokens, lambda t: hit(t).isNotNull())).alias("n_changed"))

    if not some:
        return docs.select(key, F.col(text).alias("corrected"), F.lit(0).alias("n_changed"))
    if len(some) <= mapped:
        return applied(docs, F.create_map(*(F.lit(x) for r in some for x in (r["wrong"], r["canonical"]))))
    rows = settled(docs.select(key, text).withColumn("row", F.monotonically_increasing_id()), "corrected-rows")
    words = rows.select("row", F.explode(F.array_distinct(F.transform(tokens, F.lower))).alias("wrong"))
    found = words.join(table, "wrong").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("wrong", "canonical"))).alias("pairs"))
    none = F.create_map().cast("map<string,string>")
    return applied(rows.join(found, "row", "left"), F.coalesce("pairs", none))
