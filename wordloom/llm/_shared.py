"""What several operators need: shared scratch tables and byte-level helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: str | None = None


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only where that setting is missing and the master is local (unit tests, a laptop) is a folder made here.
    """
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if _own_dir is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own_dir = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _own_dir


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage, so that a lost executor costs a reread and not a recomputation.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/wordloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discarded(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete staged tables whose successors are staged: nothing may read them any more, not even after a lost executor.

    Their writers' shuffle files go with them, once the driver's JVM collects the handles.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
    jvm.java.lang.System.gc()


def fresh(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` staged with a number of its own for each row, as ids may repeat or be null; and that column's name."""
    row = fresh(df.columns, "row_number")
    return staged(df.withColumn(row, F.monotonically_increasing_id()), "keyed", "zstd"), row


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def text_batches(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` that hold about ``limit`` bytes of ``column`` each, at least one row."""
    col = batch.column(batch.schema.get_field_index(column))
    if len(col) == 0:
        return
    sizes = np.nan_to_num(np.asarray(pc.binary_length(col).to_numpy(zero_copy_only=False), dtype=np.float64)).astype(np.int64)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(col)]
    yield from zip(cuts, cuts[1:])


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``n`` nodes over the edges ``a``-``b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        label = label[label]
        live = label[a] != label[b]
        if not live.any() and (label == before).all():
            break
        if not live.any():
            a, b = a[:0], b[:0]
            while (label[label] != label).any():
                label = label[label]
    return label


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges over arbitrary 64-bit node ids, reduced to one edge per node and component."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = local_components(len(nodes), flat[: len(a)], flat[len(a) :])
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]
