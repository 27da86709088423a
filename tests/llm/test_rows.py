"""The pipeline's stages on repeated and null ids: each row is decided by itself, and of copies exactly one stays."""

import random
from collections import Counter

import corpus_pipeline
from tests.llm._rows import documents, prose


def test_repeated_and_null_ids(spark, tmp_path):
    rng = random.Random(12)
    a, b, c, d, e = (prose(rng, 120) for _ in range(5))
    leak, other = prose(rng, 30), prose(rng, 30)
    rows = [(1, a), (1, a), (2, b), (2, "short"), (3, c), (3, prose(rng, 60) + " " + leak), (None, d), (None, d), (None, "short"), (None, other + " " + prose(rng, 60)), (4, e), (None, e)]
    spark.createDataFrame([(1, leak), (2, other)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    documents(spark, rows, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    at, steps = spark.read.parquet(str(tmp_path / "documents.parquet")), dict(corpus_pipeline.STAGES)
    held = lambda df: Counter((r["doc_id"], r["text"]) for r in df.collect())
    at = steps["quality_rules"](spark, at, str(tmp_path))
    assert held(at) == Counter(r for r in rows if r[1] != "short")
    at = steps["near_duplicates"](spark, at, str(tmp_path))
    once = set(rows) - {(2, "short"), (None, "short"), (None, e)}
    assert held(at) == Counter(once)
    want = Counter([(1, a), (2, b), (3, c), (None, d), (4, e)])
    at = steps["benchmark_leaks"](spark, steps["repeated_passages"](spark, at, str(tmp_path)), str(tmp_path))
    assert held(at) == want
    packed = corpus_pipeline.run(spark, str(tmp_path)).where("first_piece").collect()
    assert Counter(r["doc_id"] for r in packed) == Counter(k for k, _ in want) and all(r["doc_tokens"] > 50 for r in packed)
