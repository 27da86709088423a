"""Yearly name statistics (W2-W4, A5-A7). Rows: grp, name, year, cnt."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LIMITS = (100, 250, 500, 750, 1000)


def yearly_sums(rows: DataFrame) -> DataFrame:
    """A5"""
    return rows.groupBy("grp", "name", "year").agg(F.sum("cnt").alias("cnt"))


def yearly_rank(sums: DataFrame) -> DataFrame:
    """W2"""
    w = Window.partitionBy("grp", "year").orderBy(F.desc("cnt"), "name")
    return sums.withColumn("year_rank", F.row_number().over(w))


def features(ranked: DataFrame, last_year: int, recent: int = 5, top: tuple[int, int] = (50, 100)) -> DataFrame:
    """Sums, years present (also with count 0), years in the top ranks, recent sum, and maps by year."""
    year = F.col("year").cast("string")
    as_map = lambda v: F.map_from_entries(F.sort_array(F.collect_list(F.struct(year.alias("k"), F.col(v).alias("v")))))
    return ranked.groupBy("grp", "name").agg(
        F.sum("cnt").alias("cumulative_count"), F.count("*").alias("years_present"),
        F.count_if(F.col("year_rank") <= top[0]).alias(f"years_top{top[0]}"), F.count_if(F.col("year_rank") <= top[1]).alias(f"years_top{top[1]}"),
        F.coalesce(F.sum(F.when(F.col("year") > last_year - recent, F.col("cnt"))), F.lit(0)).alias("recent_count"),
        as_map("cnt").alias("year_counts"), as_map("year_rank").alias("year_ranks"),
    )


def cumulative_rank(feats: DataFrame, years_top: str = "years_top100") -> DataFrame:
    """W3"""
    w = Window.partitionBy("grp").orderBy(F.desc("cumulative_count"), F.desc(years_top), F.desc("recent_count"), "name")
    return feats.withColumn("cumulative_rank", F.row_number().over(w))


def core_and_buffer(ranked: DataFrame, core: int, buffer: int) -> DataFrame:
    """The first ``core`` of each group, and the band up to ``buffer``."""
    r = F.col("cumulative_rank")
    return ranked.where(r <= buffer).withColumn("band", F.when(r <= core, "core").otherwise("buffer"))


def thresholds(ranked: DataFrame, limits: tuple[int, ...] = LIMITS) -> DataFrame:
    """The last row inside the top n of each group."""
    n = ranked.sparkSession.createDataFrame([(x,) for x in limits], "n int")
    size = ranked.groupBy("grp").agg(F.max("cumulative_rank").alias("size"))
    want = size.join(F.broadcast(n)).withColumn("cumulative_rank", F.least("n", "size"))
    return want.join(ranked, ["grp", "cumulative_rank"]).select("grp", "n", "cumulative_rank", "name", "cumulative_count")
