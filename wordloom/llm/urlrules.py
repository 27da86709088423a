"""URL rules as intervals of reversed-host keys, matched by a sorted sweep.

A rule (host, path) covers its host and all subdomains. The key of a host is its labels in
reverse, each with a closing tab (``net\\texample\\t``), so that the host and its subdomains are one interval of
keys: those that begin with it. Rules of one host stand at one key. Addresses and rules are cut at the same
range borders; a rule is copied to each range its interval meets, which for one border are the
nested rules around it and no more. In a range, rules and addresses are read in order of their keys, and
a stack holds the rules whose interval is open. The longest match wins: the longest host, then the
longest path, then block before allow.

Only distinct (host, path) pairs are swept; the verdicts are joined back to the rows, so a hot address
costs one sweep. Rows: a null url or one without ``://`` has an empty host and path and meets
no rule; repeated rows and ties get the same verdict; very long addresses are read whole; empty tables give empty results or no rule; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import staged

#: (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DEFAULT = "allow"
_HIGH = "\U0010ffff"


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    rest = F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1)
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def host_key(host: F.Column) -> F.Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\t"), F.lit("\t")))


def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of (range, key, rules first) -> the rule of each address."""
    stack: list[tuple[str, str, str, str, str]] = []
    now = None
    for rows in batches:
        out = []
        for part, key, kind, host, path, verdict in zip(rows["part"], rows["k"], rows["kind"], rows["host"], rows["path"], rows["verdict"]):
            if part != now:
                stack, now = [], part
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, host, path, verdict, f"{host}{path}"))
                continue
            fit = [r for r in stack if path.startswith(r[2])]
            if fit:
                rule = max(fit, key=lambda r: (len(r[0]), len(r[2]), r[3] == "block"))
                out.append((host, path, rule[4], rule[3]))
        yield pd.DataFrame(out, columns=["host", "path", "rule", "rule_verdict"])


def match(pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id", default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule (null: none) and verdict. ``rules``: verdict, host, path."""
    host, path = host_and_path(F.col(url).cast("string"))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rules = rules.where("host is not null and path is not null and verdict is not null").select(F.lower("host").alias("host"), "path", "verdict").where("host <> ''").distinct()
    distinct = rows.where("host <> ''").select("host", "path").distinct().withColumn("k", host_key(F.col("host")))
    ranged = staged(distinct.repartitionByRange(F.col("k"), F.col("path")).withColumn("part", F.spark_partition_id()), "url-keys")
    borders = ranged.groupBy("part").agg(F.min("k").alias("low"), F.max("k").alias("high"))  # a row for each range
    rule_keys = rules.withColumn("k", host_key(F.col("host")))
    meets = (F.col("k") <= F.col("high")) & (F.concat(F.col("k"), F.lit(_HIGH)) >= F.col("low"))
    spread = rule_keys.join(F.broadcast(borders), meets).select("part", "k", F.lit(0).alias("kind"), "host", "path", "verdict")
    both = spread.unionByName(ranged.select("part", "k", F.lit(1).alias("kind"), "host", "path", F.lit("").alias("verdict")))
    swept = both.repartition(F.col("part")).sortWithinPartitions("part", "k", "kind", "path", "verdict").mapInPandas(sweep, "host string, path string, rule string, rule_verdict string")
    return rows.join(swept, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict"))


def rule_table(spark, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")
