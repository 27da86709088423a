"""Queries of this subpackage, one for each numbered operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_concat_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wordloom.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.quality import judge

    return judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.warc import as_responses, derivatives

    found = derivatives(as_responses(_table(spark, sf_dir, "pages")))
    return found.withColumnRenamed("source_id", "page_id").withColumn("block", F.col("block").cast("string"))


def op4_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.simhash import hex16, near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op5_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.suffix_tree import score

    return score(_table(spark, sf_dir, "documents"))


def op6_url_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.urlrules import match, rule_table

    return match(_table(spark, sf_dir, "pages"), rule_table(spark))


def op7_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.htmlblocks import extract

    return extract(_table(spark, sf_dir, "pages"))


def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.decontamination import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_suffix_group_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.suffix_dedup import removal

    return removal(_table(spark, sf_dir, "documents"))


def op10_flow_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.resharding import plan

    placed = plan(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved")


def op11_gallop_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wordloom.llm.alignment import align

    return align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_framed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wordloom.llm.records import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_concat_pack": op1_concat_pack,
    "op2_risk_controlled_quality": op2_risk_controlled_quality,
    "op3_warc_derivatives": op3_warc_derivatives,
    "op4_simhash_pigeonhole": op4_simhash_pigeonhole,
    "op5_suffix_tree_score": op5_suffix_tree_score,
    "op6_url_range_join": op6_url_range_join,
    "op7_html_blocks": op7_html_blocks,
    "op8_template_decontamination": op8_template_decontamination,
    "op9_suffix_group_dedup": op9_suffix_group_dedup,
    "op10_flow_reshard": op10_flow_reshard,
    "op11_gallop_alignment": op11_gallop_alignment,
    "op12_incremental_whitening": op12_incremental_whitening,
    "op13_framed_records": op13_framed_records,
}

ORACLE_SQL: dict[str, str] = {
    "op6_url_range_join": r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), s AS (
  SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r AS (
  SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) t(verdict, host, path)
), m AS (
  SELECT s.page_id, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host) DESC, length(r.path) DESC) AS k
  FROM s JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
)
SELECT s.page_id, s.host, s.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM s LEFT JOIN m ON m.page_id = s.page_id AND m.k = 1
""",
}
