"""Resharding by minimum-cost flow.

Documents lie in old shards; new shards have capacities in bytes. The unit of transfer is a
block: the documents of one old shard whose text falls in one hash bucket, so equal texts travel together.
A block above ``SHARE`` of a new shard's capacity is split by further bits of the text's hash, which keeps equal texts together.
Only a text whose copies take more than ``WHOLE`` of a new shard is split by the hash of the id, as no shard could be even with it. Sizes of blocks are summed by Spark; the number of blocks is
bounded by ``old shards x buckets x splits``, whatever the input. The driver solves the flow
between old and new shards, in which a byte that stays costs nothing and a moved byte costs
one, and deals whole blocks to the flow's arcs. Two broadcast joins with the bounded block table
then place each document; slots count up inside a block from the block's own start.

Rows: null text counts as empty; repeated rows keep a slot each; an empty table gives an
empty result; blocks of equal size go by their number, rows of one block by id, then text; very long texts are placed whole; other columns are ignored by
``plan`` and kept by ``rewrite``, whatever their names.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm._shared import fresh

OLD_SHARDS, NEW_SHARDS, BUCKETS = 12, 16, 4096
#: A block larger than this share of a new shard is split into up to SPLITS parts.
SHARE, SPLITS = 1 / 64, 1024
#: Copies of one text stay in one shard up to this share of it.
WHOLE = 1 / 2


def min_cost_flow(old: list[int], capacity: list[int]) -> list[list[int]]:
    """Bytes to send from each old shard to each new one; as few as possible leave their number.

    Staying is free and any move costs one unit a byte, so a flow is cheapest when it keeps as much in place as it can.
    Shortest augmenting paths over the residual network (costs 0, 1 and -1; two shards at least).
    """
    n, m = len(old), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, free = list(old), list(capacity)
    cost = lambda i, j: 0 if i == j else 1
    while any(left):
        # Label-correcting search from all old shards that still hold bytes.
        dist: dict[tuple[str, int], int] = {("o", i): 0 for i in range(n) if left[i]}
        back: dict[tuple[str, int], tuple[str, int]] = {}
        queue = deque(dist)
        while queue:
            side, i = node = queue.popleft()
            if side == "o":
                steps = [(("n", j), cost(i, j)) for j in range(m)]
            else:
                steps = [(("o", k), -cost(k, i)) for k in range(n) if flow[k][i]]
            for to, c in steps:
                if dist[node] + c < dist.get(to, 1 << 60):
                    dist[to], back[to] = dist[node] + c, node
                    queue.append(to)
        ends = [("n", j) for j in range(m) if free[j] and ("n", j) in dist]
        if not ends:
            raise ValueError("the new shards' capacities are below the old shards' bytes")
        end = min(ends, key=lambda x: (dist[x], x))
        path = [end]
        while path[-1] in back:
            path.append(back[path[-1]])
        path.reverse()
        amount = min(left[path[0][1]], free[end[1]], *(flow[b[1]][a[1]] for a, b in zip(path, path[1:]) if a[0] == "n"), 1 << 62)
        for a, b in zip(path, path[1:]):
            if a[0] == "o":
                flow[a[1]][b[1]] += amount
            else:
                flow[b[1]][a[1]] -= amount
        left[path[0][1]] -= amount
        free[end[1]] -= amount
    return flow


def deal_blocks(blocks: list[tuple[int, int, int]], flow: list[list[int]]) -> dict[int, int]:
    """New shard of each block ``(block, old shard, bytes)``; each old shard's blocks fill its arcs as near as whole blocks allow."""
    target: dict[int, int] = {}
    debt = [0] * len(flow[0])
    for shard, arcs in enumerate(flow):
        mine = sorted((b for b in blocks if b[1] == shard), key=lambda b: (-b[2], b[0]))
        rest = {j: f - debt[j] for j, f in enumerate(arcs) if f}
        for block, _, size in mine:
            j = max(rest, key=lambda j: (rest[j], j == shard, -j))
            rest[j] -= size
            target[block] = j
        for j, over in rest.items():
            debt[j] = -over
    return target


def _documents(docs: DataFrame, text: str, key: str) -> DataFrame:
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"), F.xxhash64(t).alias("h"))


def plan(docs: DataFrame, old_shard: F.Column | None = None, old_shards: int = OLD_SHARDS, capacities: list[int] | None = None, new_shards: int = NEW_SHARDS, buckets: int = BUCKETS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, old_shard, shard, slot, moved.

    ``old_shard``: where a row lies now, from 0, over the columns doc_id, size, text_crc32 and h (the text's hash);
    without it a table written by the hash of the text is assumed. ``capacities``: bytes of each new shard; without them, all are equal.
    """
    rows = _documents(docs, text, key).withColumn("old", (F.pmod("h", F.lit(old_shards)) if old_shard is None else old_shard).cast("int"))
    rows = rows.withColumn("bucket", F.pmod(F.shiftright("h", 20), F.lit(buckets)).cast("int"))
    sizes = {(r["old"], r["bucket"]): r["bytes"] for r in rows.groupBy("old", "bucket").agg(F.sum("size").alias("bytes")).collect()}
    spark = docs.sparkSession
    total = sum(sizes.values())
    least = total / new_shards if capacities is None else min(capacities)
    most, whole = max(1, int(SHARE * least)), WHOLE * least
    large = {k: min(SPLITS, -(-v // most)) for k, v in sizes.items() if v > most}
    splits = spark.createDataFrame([(*k, v) for k, v in large.items()], "old int, bucket int, splits int")
    # At most new_shards / WHOLE texts are that large if the capacities fit.
    heavy = rows.groupBy("old", "h").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).where((F.col("bytes") > whole) & (F.col("n") > 1))
    copies = spark.createDataFrame([(r["old"], r["h"], min(SPLITS, -(-r["bytes"] // most))) for r in heavy.collect()], "old int, h long, copies int")
    rows = rows.join(F.broadcast(splits), ["old", "bucket"], "left").join(F.broadcast(copies), ["old", "h"], "left")
    by_id, by_text = F.pmod(F.xxhash64("doc_id"), F.col("copies")), F.pmod(F.shiftright("h", 32), F.col("splits"))
    rows = rows.withColumn("split", F.coalesce(by_id, by_text, F.lit(0)).cast("int"))
    blocks = rows.groupBy("old", "bucket", "split").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    blocks.sort(key=lambda b: (b["old"], b["bucket"], b["split"]))
    held = [0] * old_shards
    for b in blocks:
        held[b["old"]] += b["bytes"]
    capacities = capacities or [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    target = deal_blocks([(i, b["old"], b["bytes"]) for i, b in enumerate(blocks)], min_cost_flow(held, capacities))
    filled, table = [0] * len(capacities), []
    for i, b in enumerate(blocks):
        table.append((b["old"], b["bucket"], b["split"], target[i], filled[target[i]]))
        filled[target[i]] += b["n"]
    placed = rows.join(F.broadcast(spark.createDataFrame(table, "old int, bucket int, split int, shard int, first_slot long")), ["old", "bucket", "split"])
    within = Window.partitionBy("old", "bucket", "split").orderBy("doc_id", "text_crc32", "h")
    return placed.select("doc_id", "size", "text_crc32", F.col("old").alias("old_shard"), "shard", (F.col("first_slot") + F.row_number().over(within) - 1).alias("slot"), (F.col("old") != F.col("shard")).alias("moved"))


def rewrite(spark: SparkSession, old_path: str, new_path: str, placement: DataFrame, key: str = "doc_id", text: str = "text") -> list[int]:
    """Write the files of the new shards that gain or lose rows; returns their numbers.

    ``old_path`` holds folders ``shard=N``. Shards without a moved row stay where they are and are not read again. A row finds its place by its id, its text's
    size and checksum and its old shard. ``plan`` sends rows that agree in all of these to one shard, so one place stands for all of them: repeated rows stay as many as they were.
    """
    changed = placement.where("moved").select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct()
    numbers = sorted(r["s"] for r in changed.collect())
    whole = spark.read.parquet(old_path)
    rows = whole.where(F.col("shard").isin(numbers)) if numbers else whole.limit(0)
    same = ["doc_id", "size", "text_crc32", "old_shard"]
    places = placement.where(F.col("shard").isin(numbers)).groupBy(*same).agg(F.min("shard").alias("to_shard"), F.min("slot").alias("first_slot"))
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    mine = rows.select(F.struct(*(c for c in rows.columns if c != "shard")).alias("row"), F.col(key).cast("long").alias("k0"), (F.octet_length(t) + 1).cast("long").alias("k1"), F.crc32(t.cast("binary")).alias("k2"), F.col("shard").cast("int").alias("k3"))
    met = mine.join(places, [F.col("k0").eqNullSafe(F.col("doc_id")), F.col("k1") == F.col("size"), F.col("k2") == F.col("text_crc32"), F.col("k3") == F.col("old_shard")])
    slot = fresh(rows.columns, "first_slot")
    out = met.select("row.*", F.col("to_shard").alias("shard"), F.col("first_slot").alias(slot))
    out.repartition(max(1, len(numbers)), "shard").sortWithinPartitions("shard", slot).drop(slot).write.partitionBy("shard").parquet(new_path)
    return numbers
