"""Nested counters as maps that add up (A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of one map; a key with more gets several rows.
ENTRIES = 4096


def counter_maps(long: DataFrame, keys: list[str], most: int = ENTRIES, value: str = "value", n: str = "n") -> DataFrame:
    """keys, part, counts: maps from value to count with at most ``most`` entries each, entries with equal keys and value added up.

    How many parts a key needs is known from a count of its values, and a value's part from its hash, so a key with very many values is spread
    over rows and tasks and never gathered in one list. Parts are about even: twice ``most`` is never reached at the default size.
    """
    summed = long.groupBy(*keys, value).agg(F.sum(n).alias("n"))
    sizes = summed.groupBy(*keys).agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    large = sizes.where("parts > 1")
    placed = summed.join(large, keys, "left").withColumn("part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(value), "parts")).otherwise(0).cast("int"))
    return placed.groupBy(*keys, "part").agg(F.map_from_entries(F.collect_list(F.struct(F.col(value), "n"))).alias("counts"))


def map_entries(maps: DataFrame, keys: list[str]) -> DataFrame:
    """keys, value, n of ``counter_maps``."""
    return maps.select(*keys, F.explode("counts").alias("value", "n"))


def merged_maps(keys: list[str], *maps: DataFrame, most: int = ENTRIES) -> DataFrame:
    """Counters of several batches as one, however their maps were cut."""
    rows = map_entries(maps[0], keys)
    for m in maps[1:]:
        rows = rows.unionByName(map_entries(m, keys))
    return counter_maps(rows, keys, most)
