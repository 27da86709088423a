"""Coverage, collisions, snapshots and triage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.config import LexiconConfig
from wordloom.functions import text as X


def coverage_status(names: DataFrame, pack: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """names(kind, canonical) against pack(surface)."""
    variants = pack.groupBy(F.lower("surface").alias("key")).agg(F.sort_array(F.collect_set("surface")).alias("current_variants"))
    out = names.withColumn("key", F.lower("canonical")).join(variants, "key", "left")
    status = F.when(F.array_contains("current_variants", F.col("canonical")), "canonical_present").when(F.col("current_variants").isNotNull(), "lowercase_only").otherwise("missing_from_pack")
    out = out.withColumn("status", status).withColumn("current_variants", F.coalesce("current_variants", F.array().cast("array<string>")))
    if reviewed is None:
        return out.withColumn("reviewed", F.lit(False))
    return out.join(reviewed.select(F.lower("surface").alias("key"), F.lit(True).alias("reviewed")).distinct(), "key", "left").withColumn("reviewed", F.coalesce("reviewed", F.lit(False)))


def status_counts(rows: DataFrame, kind: str = "kind", status: str = "status", totals: bool = False) -> DataFrame:
    """A18, A20; ``totals`` adds subtotals."""
    grouped = rows.rollup(kind, status) if totals else rows.groupBy(kind, status)
    return grouped.agg(F.count("*").alias("n"))


def kind_collisions(names: DataFrame) -> DataFrame:
    """Keys under more than one kind. names: kind, canonical. Aggregates, so a hot key is never gathered."""
    return names.groupBy(F.lower("canonical").alias("key")).agg(F.sort_array(F.collect_set("kind")).alias("kinds")).where(F.size("kinds") > 1)


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Key, change (added, removed, rank_changed), old and new rank."""
    both = old.select("key", F.col("rank").alias("old_rank")).join(new.select("key", F.col("rank").alias("new_rank")), "key", "full")
    change = F.when(F.col("old_rank").isNull(), "added").when(F.col("new_rank").isNull(), "removed").when(F.col("old_rank") != F.col("new_rank"), "rank_changed")
    return both.withColumn("change", change).where("change is not null")


def accent_index(ranked: DataFrame, cfg: LexiconConfig) -> DataFrame:
    """A10: fold key -> candidates in order of rank."""
    return ranked.groupBy(X.fold(F.col("word"), cfg).alias("fold")).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("candidates"))


def probe_index(probes: DataFrame, ranked: DataFrame, index: DataFrame, unigrams: DataFrame, cfg: LexiconConfig) -> DataFrame:
    """probes(word) -> whether listed, rank, fold key, candidates, whether a unigram."""
    out = probes.withColumn("fold", X.fold(F.col("word"), cfg)).join(ranked.select("word", "rank"), "word", "left").join(index, "fold", "left")
    out = out.join(unigrams.select("word", F.lit(True).alias("unigram")).distinct(), "word", "left")
    return out.withColumn("listed", F.col("rank").isNotNull()).withColumn("unigram", F.coalesce("unigram", F.lit(False)))


def evidence_coverage(rows: DataFrame, flags: list[str]) -> DataFrame:
    """Counts and percentages of each flag in one row; 0 of none is 0."""
    n = F.count("*")
    out = [n.alias("n")]
    for f in flags:
        hits = F.count_if(F.col(f))
        out += [hits.alias(f"n_{f}"), F.when(n > 0, F.round(100 * hits / n, 2)).otherwise(F.lit(0.0)).alias(f"pct_{f}")]
    return rows.agg(*out)


def triage(names: DataFrame, population: DataFrame, zipfs: DataFrame, cfg: LexiconConfig, k: int = 500) -> DataFrame:
    """The ``k`` first by (population, common-word flag, zipf descending, name); absent numbers stay NULL."""
    rows = names.withColumn("key", F.lower("canonical")).join(population.select(F.lower("name").alias("key"), "population"), "key", "left").join(zipfs.select(F.col("word").alias("key"), "zipf"), "key", "left")
    rows = rows.withColumn("common_word_signal", F.coalesce(F.col("zipf") >= cfg.common_zipf, F.lit(False)))
    return rows.orderBy(F.coalesce("population", F.lit(0)).desc(), F.col("common_word_signal").asc(), F.coalesce("zipf", F.lit(0.0)).desc(), "canonical").limit(k)
