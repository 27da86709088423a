"""Surface registry and module resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text as X
from wordloom.operators.selecting import override


def canonicalize(source: DataFrame, overrides: DataFrame | None = None, conflict_mode: str = "strict") -> tuple[DataFrame, DataFrame]:
    """Key, surface, policy of a source's components, and conflicts.

    source: surface and, if known, policy. ``conflict_mode``: strict (policy and surface must agree),
    prefer_capitalized or prefer_lowercase (that policy wins; conflicts stay listed only in strict mode).
    """
    phrase = F.col("policy") if "policy" in source.columns else X.case_policy(F.col("surface"))
    parts = source.select(phrase.alias("phrase_policy"), F.explode(X.dictionary_surfaces(F.col("surface"))).alias("surface"))
    rows = parts.withColumn("policy", X.component_policy(F.col("surface"), F.col("phrase_policy"))).withColumn("key", F.lower("surface"))
    rows = rows.withColumn("surface", X.apply_policy(F.col("surface"), F.col("policy"))).select("key", "surface", "policy")
    if overrides is not None:
        rows = override(rows, overrides)
    rows = rows.distinct()
    grouped = rows.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("policy", "surface"))).alias("v"))
    if conflict_mode == "strict":
        return grouped.where(F.size("v") == 1).select("key", F.col("v")[0]["surface"].alias("surface"), F.col("v")[0]["policy"].alias("policy")), grouped.where(F.size("v") > 1)
    wanted = "capitalized" if conflict_mode == "prefer_capitalized" else "lowercase"
    liked = F.filter("v", lambda x: x["policy"] == wanted)
    best = F.when(F.size(liked) > 0, liked[0]).otherwise(F.col("v")[0])
    return grouped.select("key", best["surface"].alias("surface"), best["policy"].alias("policy")), grouped.where("false")


def build_registry(sources: dict[str, DataFrame], kept: DataFrame) -> DataFrame:
    """R2: key, surface, policy, source for kept keys; keys of no source are ordinary vocabulary."""
    keys = kept.select(F.lower("word").alias("key")).distinct()
    rows = None
    for name, s in sources.items():
        part = s.select("key", "surface", "policy", F.lit(name).alias("source"))
        rows = part if rows is None else rows.unionByName(part)
    found = keys.withColumn("surface", F.lit(None).cast("string")).withColumn("policy", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string")) if rows is None else keys.join(rows.distinct(), "key", "left")
    ordinary = F.col("source").isNull()
    return found.select("key", F.when(ordinary, F.col("key")).otherwise(F.col("surface")).alias("surface"), F.when(ordinary, "lowercase").otherwise(F.col("policy")).alias("policy"), F.coalesce("source", F.lit("ordinary-vocabulary")).alias("source"))


def resolve_registry(registry: DataFrame, core: DataFrame | None = None, module: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """Key, surface, policy, basis, conflict, several_surfaces.

    Order: core verdict, module verdict, override, mixed policies (conflict), the only variant, lower case. A verdict whose
    lower case isn't the key is a conflict. Of several surfaces with one policy the smallest is taken and flagged.
    """
    explicit = F.col("source") != "ordinary-vocabulary"
    out = registry.groupBy("key").agg(
        F.sort_array(F.collect_set(F.when(explicit, F.col("policy")))).alias("policies"),
        F.sort_array(F.collect_set(F.when(explicit, F.col("surface")))).alias("surfaces"),
    )
    for name, df in (("c", core), ("m", module), ("o", overrides)):
        part = out.select("key").withColumn(name, F.lit(None).cast("struct<surface:string,policy:string>")) if df is None else df.select("key", F.struct("surface", "policy").alias(name)).dropDuplicates(["key"])
        out = out.join(part, "key", "left")
    audited = F.coalesce("c", "m")
    pick = lambda field, default: (
        F.when(audited.isNotNull(), audited[field]).when(F.col("o").isNotNull(), F.col("o")[field]).when(F.size("policies") > 1, F.lit(None).cast("string")).when(F.size("policies") == 1, F.col("surfaces" if field == "surface" else "policies")[0]).otherwise(default)
    )
    basis = F.when(F.col("c").isNotNull(), "core-audit").when(F.col("m").isNotNull(), "module-audit").when(F.col("o").isNotNull(), "override").when(F.size("policies") > 1, "conflict").when(F.size("policies") == 1, "source").otherwise("ordinary-vocabulary")
    out = out.select("key", pick("surface", F.col("key")).alias("surface"), pick("policy", F.lit("lowercase")).alias("policy"), basis.alias("basis"), (F.size("surfaces") > 1).alias("several_surfaces"))
    bad = F.col("surface").isNull() | (F.lower("surface") != F.col("key")) | ~F.coalesce(F.col("policy").isin("lowercase", "capitalized"), F.lit(False))
    return out.withColumn("conflict", bad)


def merge_modules(core: DataFrame, base: DataFrame, module: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Key, surface of the union, and keys without any surface. core, module: key, surface (verdicts). base: key, surface."""
    rows = base.select("key", F.col("surface").alias("b")).join(core.select("key", F.col("surface").alias("c")), "key", "full").join(module.select("key", F.col("surface").alias("m")), "key", "full")
    out = rows.select("key", F.coalesce("c", "b", "m").alias("surface"))
    return out.where("surface is not null"), out.where("surface is null")


def variant_entries(resolved: DataFrame, variants: DataFrame, flags: DataFrame) -> DataFrame:
    """Key and its JSON entry: default surface, variants, flags; unknown fields are left out."""
    v = variants.groupBy("key").agg(F.sort_array(F.collect_set("surface")).alias("variants"))
    rows = resolved.join(v, "key", "left").join(flags.select("key", "common_noun", "proper_name"), "key", "left")
    entry = F.struct("key", F.col("surface").alias("canonicalForm"), F.struct(F.col("surface").alias("default"), "variants").alias("capitalization"), F.struct(F.col("common_noun").alias("commonNoun"), F.col("proper_name").alias("properName")).alias("flags"))
    return rows.select("key", F.to_json(entry).alias("entry"))
