"""Aggregates kept up to date from a stream: a versioned base, deltas by epoch, compaction.

A state is any table of keys and aggregates that add up (sums, counts, maxima). Layout under the target folder:

    base/version=N          the state up to some epoch
    deltas/version=N/epoch=E   what epoch E adds, written while version N was current
    commits/                one row for each version: version, upto (the last epoch in its base)

A version counts once its commit row is there, and that is one small file that the writer moves into place after the base is whole: a crash
before it leaves the old version and its deltas untouched. An epoch's delta is overwritten when the epoch is replayed, and a replay of an epoch that
a base already holds falls under ``upto`` and is never read. Readers list the current version's deltas alone, so a read costs one base and a few deltas
and not all of history. One writer at a time, as a streaming query is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

_COMMIT = "version long, upto long"


@dataclass(frozen=True)
class Store:
    """``keys``, and how the other columns add up: ``sum`` or ``max`` by name."""

    target: str
    keys: tuple[str, ...]
    adds: tuple[tuple[str, str], ...]
    schema: StructType | str

    def _table(self, spark: SparkSession, folder: str) -> DataFrame:
        try:
            return spark.read.schema(self.schema).parquet(f"{self.target}/{folder}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return spark.createDataFrame([], self.schema)

    def version(self, spark: SparkSession) -> tuple[int, int]:
        """The current version and the last epoch in its base; (0, -1) before the first."""
        try:
            row = spark.read.schema(_COMMIT).parquet(f"{self.target}/commits").orderBy(F.desc("version")).first()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            row = None
        return (row["version"], row["upto"]) if row else (0, -1)

    def merged(self, *states: DataFrame) -> DataFrame:
        """States of disjoint input as one."""
        rows = states[0]
        for s in states[1:]:
            rows = rows.unionByName(s)
        return rows.groupBy(*self.keys).agg(*({"sum": F.sum, "max": F.max}[how](c).alias(c) for c, how in self.adds))

    def _deltas(self, spark: SparkSession, version: int, upto: int) -> DataFrame:
        columns = StructType.fromDDL(self.schema) if isinstance(self.schema, str) else self.schema
        schema = StructType([*columns, StructField("epoch", LongType())])
        try:
            rows = spark.read.schema(schema).parquet(f"{self.target}/deltas/version={version}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return spark.createDataFrame([], schema)
        return rows.where(F.col("epoch") > upto)

    def add(self, delta: DataFrame, epoch: int) -> None:
        """Record what ``epoch`` adds; again, if it is replayed."""
        version, upto = self.version(delta.sparkSession)
        if epoch > upto:
            delta.write.mode("overwrite").parquet(f"{self.target}/deltas/version={version}/epoch={epoch}")

    def current(self, spark: SparkSession) -> DataFrame:
        version, upto = self.version(spark)
        deltas = self._deltas(spark, version, upto).drop("epoch")
        return self.merged(self._table(spark, f"base/version={version}"), deltas) if version else self.merged(deltas)

    def write_base(self, spark: SparkSession) -> tuple[int, int] | None:
        """The next version's base from the current one and its deltas, not yet in force; None where there is nothing to fold in."""
        version, upto = self.version(spark)
        last = self._deltas(spark, version, upto).agg(F.max("epoch")).first()[0]
        if last is None:
            return None
        deltas = self._deltas(spark, version, upto).where(F.col("epoch") <= last).drop("epoch")
        base = self._table(spark, f"base/version={version}") if version else None
        (self.merged(base, deltas) if version else self.merged(deltas)).write.mode("overwrite").parquet(f"{self.target}/base/version={version + 1}")
        return version + 1, last

    def commit(self, spark: SparkSession, version: int, upto: int) -> None:
        spark.createDataFrame([(version, upto)], _COMMIT).coalesce(1).write.mode("append").parquet(f"{self.target}/commits")

    def compact(self, spark: SparkSession) -> int:
        """Fold the deltas into a new base and put it in force; returns the current version."""
        made = self.write_base(spark)
        if made:
            self.commit(spark, *made)
        return self.version(spark)[0]

    def expire(self, spark: SparkSession) -> list[str]:
        """Delete bases and deltas of versions before the current one, which no reader opens any more; returns their folders."""
        from pyarrow import fs

        system, top = fs.FileSystem.from_uri(self.target) if "://" in self.target or self.target.startswith("file:") else (fs.LocalFileSystem(), self.target)
        version, _ = self.version(spark)
        gone = []
        for part in ("base", "deltas"):
            for entry in system.get_file_info(fs.FileSelector(f"{top}/{part}", allow_not_found=True)):
                name = entry.base_name
                if name.startswith("version=") and int(name.removeprefix("version=")) < version:
                    system.delete_dir(entry.path)
                    gone.append(f"{part}/{name}")
        return sorted(gone)
