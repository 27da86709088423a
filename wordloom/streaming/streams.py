"""Case preferences, decay and incremental counts (T1-T3): the same expressions in batch and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as X
from wordloom.streaming.store import Store

LEAST_USES, LEAST_LEAD = 5, 2


def preference(lower: Column, upper: Column, default: Column, uses: int = LEAST_USES, lead: int = LEAST_LEAD) -> Column:
    """Switch only with enough uses and a clear lead, else the audited default."""
    return F.when((lower >= uses) & (lower - upper >= lead), "lowercase").when((upper >= uses) & (upper - lower >= lead), "capitalized").otherwise(default)


def case_preferences(events: DataFrame, default: str = "lowercase") -> DataFrame:
    """T1 over events(user_id, key, surface), batch or stream (``update`` mode)."""
    up = X.starts_upper(F.col("surface"))
    out = events.groupBy("user_id", "key").agg(F.count_if(~up).alias("lowercase_uses"), F.count_if(up).alias("capitalized_uses"))
    return out.withColumn("preferred", preference(F.col("lowercase_uses"), F.col("capitalized_uses"), F.lit(default)))


def windowed_uses(events: DataFrame, keys: list[str], length: str = "1 hour", slide: str | None = None, delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Counts by event-time window; rows later than the watermark may be dropped on a stream."""
    rows = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", delay)
    w = F.window("__ts", length, slide) if slide else F.window("__ts", length)
    return rows.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("uses")).select(F.col("w.start").alias("window_start"), *keys, "uses")


def word_store(target: str) -> Store:
    return Store(target, ("lang", "word"), (("cnt", "sum"),), "lang string, word string, cnt long")


def incremental_word_counts(docs: DataFrame, target: str, checkpoint: str, text: str = "text", lang: str = "lang", compact_every: int = 16):
    """Each batch of new documents adds its counts as a delta of its epoch; every ``compact_every`` epochs the deltas are folded into a new base."""
    store = word_store(target)

    def upsert(batch: DataFrame, epoch: int) -> None:
        words = batch.select(F.col(lang).alias("lang"), F.explode(X.words(F.col(text))).alias("word"))
        store.add(words.groupBy("lang", "word").agg(F.count("*").alias("cnt")), epoch)
        if (epoch + 1) % compact_every == 0:
            store.compact(batch.sparkSession)

    return docs.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_counts(spark: SparkSession, target: str) -> DataFrame:
    return word_store(target).current(spark)


def decay_state(events: DataFrame, keys: list[str], half_life: float, bucket: float, ts: str = "ts", marks: dict[str, Column] | None = None) -> DataFrame:
    """Uses that lose half their weight every ``half_life`` seconds, as sums by key and time bucket.

    keys, bucket_end (seconds since 1970), and for each mark (default ``uses``: every row) the weight that its rows have at the bucket's end, and last (the latest
    time). A bucket's sums don't depend on the order of rows, so batches, streams and late rows give one state; states add up (``Store``).
    """
    at = F.col(ts).cast("timestamp").cast("double")
    end = (F.floor(at / bucket) + 1) * bucket
    weight = F.pow(F.lit(2.0), (at - end) / half_life)
    sums = [F.coalesce(F.sum(F.when(c, weight)), F.lit(0.0)).alias(n) for n, c in (marks or {"uses": F.lit(True)}).items()]
    return events.groupBy(*keys, end.alias("bucket_end")).agg(*sums, F.max(at).alias("last"))


def decay_store(target: str, keys: dict[str, str], marks: list[str]) -> Store:
    """A store of decayed uses; ``keys`` with their types."""
    columns = [*(f"{k} {t}" for k, t in keys.items()), "bucket_end double", *(f"{m} double" for m in marks), "last double"]
    return Store(target, (*keys, "bucket_end"), (*((m, "sum") for m in marks), ("last", "max")), ", ".join(columns))


def decayed(state: DataFrame, keys: list[str], half_life: float, at: float, marks: tuple[str, ...] = ("uses",)) -> DataFrame:
    """Each key's weights at the time ``at`` (seconds since 1970, not before the last event)."""
    left = F.pow(F.lit(2.0), (F.col("bucket_end") - at) / half_life)
    return state.groupBy(*keys).agg(*(F.sum(F.col(m) * left).alias(m) for m in marks), F.max("last").alias("last"))


def folded(state: DataFrame, keys: list[str], half_life: float, until: float, marks: tuple[str, ...] = ("uses",)) -> DataFrame:
    """The same state with all buckets that end by ``until`` moved into one that ends there; nothing is lost but the time within it."""
    old = F.col("bucket_end") <= until
    moved = state.select(*keys, F.when(old, until).otherwise(F.col("bucket_end")).alias("to"), *((F.col(m) * F.when(old, F.pow(F.lit(2.0), (F.col("bucket_end") - until) / half_life)).otherwise(1.0)).alias(m) for m in marks), "last")
    return moved.groupBy(*keys, F.col("to").alias("bucket_end")).agg(*(F.sum(m).alias(m) for m in marks), F.max("last").alias("last"))


def stream_decay(events: DataFrame, store: Store, checkpoint: str, half_life: float, bucket: float, keys: list[str], ts: str = "ts", marks: dict[str, Column] | None = None, compact_every: int = 16):
    """T2 on a stream: every batch adds its state as a delta; no row is too late."""

    def upsert(batch: DataFrame, epoch: int) -> None:
        store.add(decay_state(batch, keys, half_life, bucket, ts, marks), epoch)
        if (epoch + 1) % compact_every == 0:
            store.compact(batch.sparkSession)

    return events.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
