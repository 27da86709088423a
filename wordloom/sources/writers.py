"""Sinks (K1-K5)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.text import reason_class


def _lines(rows: DataFrame, head: DataFrame, keys: list[str], line) -> DataFrame:  # noqa: ANN001
    """Head lines (place, value), then the rows' lines by ``keys``: one range sort, so the part files in order are the file and only the first has the head."""
    key = F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)))
    body = rows.select(F.lit(1).alias("section"), F.lit(0).alias("place"), key.alias("key"), line.alias("value"))
    top = head.select(F.lit(0).alias("section"), "place", F.lit(None).cast(body.schema["key"].dataType).alias("key"), "value")
    return top.unionByName(body).orderBy("section", "place", "key", "value").select("value")


def write_wordlist(words: DataFrame, path: str, column: str = "surface", counts: dict[str, Column] | None = None) -> None:
    """K1: lines in code-point order under one header line ``# name: count`` for each of ``counts`` (aggregates over the words), in the order given.

    The words are staged, so the counts are those of the very rows that are written.
    """
    rows = settled(words, "wordlist") if counts else words
    head = rows.sparkSession.createDataFrame([], "place int, value string")
    if counts:
        named = F.array(*(F.concat(F.lit(f"# {n}: "), F.col(n).cast("string")) for n in counts))
        head = rows.agg(*(c.alias(n) for n, c in counts.items())).select(F.posexplode(named).alias("place", "value"))
    _lines(rows, head, [column], F.col(column)).write.text(path)


def write_tsv(rows: DataFrame, path: str, fields: list[str], keys: list[str]) -> None:
    """K2: fixed field order and sort keys under one header line; lists are joined by ``;``, nulls are empty, a cell with a tab, line end or quote is quoted."""
    kinds = dict(rows.dtypes)
    plain = [F.coalesce(F.array_join(f, ";") if kinds[f].startswith("array") else F.col(f).cast("string"), F.lit("")) for f in fields]
    cells = [F.when(c.rlike('[\\t\\r\\n"]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c) for c in plain]
    head = rows.sparkSession.range(1).select(F.lit(0).alias("place"), F.lit("\t".join(fields)).alias("value"))
    _lines(rows, head, keys, F.concat_ws("\t", *cells)).write.text(path)


def report_json(summary: DataFrame) -> DataFrame:
    """K3: one JSON text for each summary row."""
    return summary.select(F.to_json(F.struct("*")).alias("value"))


def source_manifest(spark: SparkSession, path) -> DataFrame:
    """K4: path, length, sha256 and time of each source file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), "modificationTime")


_own_dir: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Only where that setting is missing and the master is local (unit tests, a laptop) is a folder made here."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        top = _own_dir[0]
    return top.rstrip("/")


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, for results that several branches of a plan read."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lexicon/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_decisions(decisions: DataFrame, path: str) -> None:
    """K5: a row for each key with its decision and reason, by class of reason."""
    decisions.withColumn("reason_class", reason_class(F.col("reason"))).write.partitionBy("reason_class").parquet(path)
