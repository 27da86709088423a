"""Gates (G1-G8, U1-U4): each returns its violations as rows; ``strict`` raises on any."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.records import casing_error


class GateError(ValueError):
    pass


def strict(violations: DataFrame, gate: str) -> None:
    some = violations.limit(5).collect()
    if some:
        raise GateError(f"{gate}: {some}")


def cardinality(df: DataFrame, expected: Mapping[str, int], by: Column | None = None) -> DataFrame:
    """Name, expected, actual, ok. Without ``by``, the single name in ``expected`` is the table."""
    spark = df.sparkSession
    want = spark.createDataFrame(list(expected.items()), "name string, expected long")
    name = F.lit(next(iter(expected))) if by is None else by
    have = df.groupBy(name.alias("name")).agg(F.count("*").alias("actual"))
    out = want.join(have, "name", "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return out.withColumn("ok", F.col("expected") == F.col("actual"))


def domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """G2"""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(*allowed))


def missing(required: DataFrame, present: DataFrame, on: str | list[str]) -> DataFrame:
    """Required rows that aren't present."""
    return required.join(present, on, "left_anti")


def conflicts(df: DataFrame, key: str | list[str], value: str) -> DataFrame:
    """Keys with several values."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n_values"), F.sort_array(F.collect_set(value)).alias("values")).where("n_values > 1")


def duplicates(df: DataFrame, keys: list[str], fold_case: bool = False) -> DataFrame:
    """G5"""
    by = [F.lower(k).alias(k) if fold_case else F.col(k) for k in keys]
    return df.groupBy(*by).count().where("count > 1")


def casing_gate(df: DataFrame, surface: str = "surface", policy: str = "policy") -> tuple[DataFrame, DataFrame]:
    """Violations, and the one-row summary (kept, checked, failed)."""
    marked = df.withColumn("error", casing_error(F.col(surface), F.col(policy)))
    return marked.where("error is not null"), marked.agg(F.count("*").alias("kept"), F.count(surface).alias("checked"), F.count("error").alias("failed"))


def agreement(core: DataFrame, module: DataFrame) -> DataFrame:
    """Keys that core and module resolve differently. Both: key, surface, policy."""
    m = module.select("key", F.col("surface").alias("module_surface"), F.col("policy").alias("module_policy"))
    return core.join(m, "key").where((F.col("surface") != F.col("module_surface")) | (F.col("policy") != F.col("module_policy")))


def text_file_gate(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row: lines, carriage returns, control characters, and whether the file passes."""
    v = F.col(column)
    out = lines.agg(F.count("*").alias("lines"), F.count_if(v.contains("\r")).alias("carriage_returns"), F.count_if(v.rlike(r"[\p{Cntrl}&&[^\t\r]]")).alias("controls"))
    return out.withColumn("ok", (F.col("lines") > 0) & (F.col("carriage_returns") == 0) & (F.col("controls") == 0))


def evidence_union(*sets: DataFrame) -> DataFrame:
    """Distinct rows of one-column sets."""
    out = sets[0]
    for s in sets[1:]:
        out = out.union(s)
    return out.distinct()


def overlap(a: DataFrame, b: DataFrame, on: str = "word") -> DataFrame:
    """One row with the sizes of both, of the intersection and of both differences, by one full join."""
    both = a.select(on).distinct().withColumn("in_a", F.lit(True)).join(b.select(on).distinct().withColumn("in_b", F.lit(True)), on, "full")
    return both.agg(F.count("in_a").alias("n_a"), F.count("in_b").alias("n_b"), F.count_if(F.col("in_a") & F.col("in_b")).alias("n_both"), F.count_if(F.col("in_b").isNull()).alias("only_a"), F.count_if(F.col("in_a").isNull()).alias("only_b"))
