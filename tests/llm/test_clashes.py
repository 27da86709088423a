"""Columns with the names that operators once used inside, repeated rows and ids, strata and records without a name."""

from pyspark.sql import functions as F

from tests.llm._rows import documents, prose
from wordloom.llm import decontamination, quality, resharding, simhash, suffix_dedup, warc
from wordloom.llm._shared import fresh

NAMES = ("__row", "row_number", "ROW_NUMBER_", "__runs", "row_hash", "repeated_runs", "__quality", "quality_counts", "quality_0", "__0", "number", "place", "row", "document", "shard_", "first_slot")


def clashing(spark, rows):
    df = documents(spark, rows, extra=False)
    for i, c in enumerate(NAMES):
        df = df.withColumn(c, F.lit(i))
    return df


def texts(n=12):
    import random

    rng = random.Random(4)
    return [(i, prose(rng, 80), "en") for i in range(n)]


def check(spark, out, columns):
    assert out.columns == columns
    for r in out.collect():
        assert [r[c] for c in NAMES] == list(range(len(NAMES)))


def test_stages_leave_other_columns_alone(spark):
    rows = texts()
    df = clashing(spark, [*rows, (50, rows[0][1], "en"), (50, rows[1][1], "en"), (None, rows[2][1], None)])
    bench = spark.createDataFrame([(1, rows[3][1])], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    for out, n in ((quality.keep(df, labels), 15), (simhash.keep_one(df), 12), (suffix_dedup.dedup_text(df), 15), (decontamination.clean(df, bench), 14)):
        check(spark, out, df.columns)
        assert out.count() == n


def test_fresh_names():
    assert fresh(["A", "b"], "a") == "a_" and fresh(["a", "A_"], "a") == "a__" and fresh([], "x") == "x"


def test_rewrite_keeps_repeated_rows(spark, tmp_path):
    rows = [(i % 60, f"text {i % 90} " * (i % 7 + 1)) for i in range(240)] + [(None, "no id"), (None, None), (3, None)]
    docs = documents(spark, rows, extra=False)
    placed = resharding.plan(docs, old_shards=3, new_shards=4, buckets=32)
    old = docs.withColumn("shard", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(3)).cast("int"))
    old.write.partitionBy("shard").parquet(str(tmp_path / "old"))
    changed = resharding.rewrite(spark, str(tmp_path / "old"), str(tmp_path / "new"), placed)
    new = spark.read.parquet(str(tmp_path / "new"))
    want = placed.where(F.col("shard").isin(changed)).groupBy("doc_id", "text_crc32", "shard").count()
    got = new.groupBy("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), "shard").count()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and new.count() == placed.where(F.col("shard").isin(changed)).count()


def test_labels_count_a_text_once(spark):
    rows = texts(6)
    many = [*rows, *((0, rows[0][1], "en") for _ in range(5)), (77, rows[1][1], "en"), (2, rows[2][1], ""), (2, rows[2][1], None)]
    feats = quality.features(documents(spark, many))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)] + [(77, 0, 0), (77, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality._labelled(feats, labels, "quality", "doc_id").groupBy("stratum").agg(F.count("*").alias("n"), F.count_if("good").alias("g")).collect()
    assert {r["stratum"]: (r["n"], r["g"]) for r in got} == {"en": (5, 5), "": (1, 1), quality.NO_STRATUM: (1, 1)}


def test_records_without_an_id_get_ids_of_their_own(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (2, "u", "<p>b")], "page_id long, url string, html string")
    found = warc.derivatives(warc.as_responses(pages).withColumn("record_id", F.lit(None).cast("string"))).collect()
    assert len({r["record_id"] for r in found}) == 4 and {r["refers_to"] for r in found} == {None}
