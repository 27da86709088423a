"""Vocabulary profiles and evaluations (V1-V6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.sources.writers import settled


def ancestors(profiles: DataFrame) -> DataFrame:
    """name, ancestor, distance: every profile with itself (0), its base (1) and all theirs.

    Pointers are doubled: round k knows all ancestors nearer than 2 ** k, so a chain of any depth takes logarithmically many rounds, each of one join.
    A profile among its own ancestors is in a cycle, which raises. A base that has no row of its own adds nothing.
    """
    links = settled(profiles.select("name", F.col("base").alias("up")).join(profiles.select(F.col("name").alias("up")), "up", "left_semi"), "bases")
    found = profiles.select("name", F.col("name").alias("ancestor"), F.lit(0).cast("long").alias("distance"))
    reach = 1
    while not links.isEmpty():
        # What the profile ``reach`` steps up knows, that many steps further.
        theirs = found.select(F.col("name").alias("up"), "ancestor", (F.col("distance") + reach).alias("distance"))
        found = settled(found.unionByName(links.join(theirs, "up").select("name", "ancestor", "distance")), "ancestors")
        if around := found.where("name = ancestor and distance > 0").limit(5).collect():
            raise ValueError(f"profiles inherit in a cycle: {sorted({r['name'] for r in around})}")
        links = settled(links.join(links.select(F.col("name").alias("up"), F.col("up").alias("further")), "up").select("name", F.col("further").alias("up")), "bases")
        reach *= 2
    return found


def resolve_profiles(profiles: DataFrame) -> DataFrame:
    """V1: name, modules, priority, depth: modules from the root down, each at its first place; the nearest profile's priority for each key wins."""
    rows = ancestors(profiles).join(profiles.select(F.col("name").alias("ancestor"), "modules", "priority"), "ancestor")
    order = F.struct((-F.col("distance")).alias("d"), F.col("i").alias("i"))
    modules = rows.select("name", "distance", F.posexplode("modules").alias("i", "module")).groupBy("name", "module").agg(F.min(order).alias("o"))
    modules = modules.groupBy("name").agg(F.transform(F.sort_array(F.collect_list(F.struct("o", "module"))), lambda x: x["module"]).alias("modules"))
    nearest = rows.select("name", "distance", F.explode("priority").alias("k", "v")).groupBy("name", "k").agg(F.min_by("v", "distance").alias("v"))
    priority = nearest.groupBy("name").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("priority"))
    depth = rows.groupBy("name").agg(F.max("distance").alias("depth"))
    none, empty = F.array().cast("array<string>"), F.create_map().cast("map<string,double>")
    return depth.join(modules, "name", "left").join(priority, "name", "left").select("name", F.coalesce("modules", none).alias("modules"), F.coalesce("priority", empty).alias("priority"), "depth")


def profile_vocabulary(profile: DataFrame, terms: DataFrame, core: DataFrame) -> DataFrame:
    """V2: name, word, score = frequency x priority. terms: module, word, frequency. core: word, frequency (priority 1)."""
    p = profile.select("name", "priority", F.explode("modules").alias("module"))
    own = p.join(terms, "module").select("name", "word", (F.col("frequency") * F.coalesce(F.try_element_at("priority", F.col("module")), F.lit(1.0))).alias("score"))
    rest = profile.select("name").crossJoin(core.select("word", F.col("frequency").cast("double").alias("score")))
    return own.unionByName(rest.select("name", "word", "score")).groupBy("name", "word").agg(F.max("score").alias("score"))


def with_priority(words: DataFrame, priorities: DataFrame, default: int = 0) -> DataFrame:
    """V3"""
    return words.join(priorities.select("word", "priority", "reason"), "word", "left").withColumn("priority", F.coalesce("priority", F.lit(default)))


def assemble(layers: dict[str, DataFrame], keep_first: bool = False) -> DataFrame:
    """V4: layer, surface; no dedupe unless ``keep_first`` (by lower key, in the order of the layers)."""
    out = None
    for i, (name, df) in enumerate(layers.items()):
        part = df.select(F.lit(i).alias("ord"), F.lit(name).alias("layer"), "surface")
        out = part if out is None else out.unionByName(part)
    if keep_first:
        best = F.min(F.struct("ord", "surface", "layer")).alias("b")
        out = out.groupBy(F.lower("surface").alias("k")).agg(best).select("b.ord", "b.layer", "b.surface")
    return out.select("layer", "surface")


def ranking_evaluation(predictions: DataFrame, gold: DataFrame, default: str = "default") -> DataFrame:
    """V5: system, grp -> cases, top1, top3, fixed and broken against the default. predictions: case_id, system, rank, surface."""
    hit = predictions.join(gold.select("case_id", "grp", F.col("surface").alias("gold")), "case_id")
    per = hit.groupBy("case_id", "grp", "system").agg(F.max((F.col("surface") == F.col("gold")) & (F.col("rank") == 1)).alias("top1"), F.max((F.col("surface") == F.col("gold")) & (F.col("rank") <= 3)).alias("top3"))
    base = per.where(F.col("system") == default).select("case_id", F.col("top1").alias("base"))
    return per.join(base, "case_id", "left").groupBy("system", "grp").agg(F.count("*").alias("cases"), F.count_if("top1").alias("top1"), F.count_if("top3").alias("top3"), F.count_if(F.col("top1") & ~F.col("base")).alias("fixed"), F.count_if(~F.col("top1") & F.col("base")).alias("broken"))


def latency_percentiles(samples: DataFrame, by: list[str], value: str = "ms") -> DataFrame:
    """V6"""
    p = F.percentile(value, F.array(F.lit(0.5), F.lit(0.95)))
    return samples.groupBy(*by).agg(F.count("*").alias("n"), p.alias("p")).select(*by, "n", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"))
