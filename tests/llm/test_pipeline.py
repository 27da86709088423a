"""The stages in order on planted cases, each held against what it must keep and drop."""

import random

import corpus_pipeline
from tests.llm._rows import documents, prose


def test_stages_on_planted_documents(spark, tmp_path):
    rng = random.Random(9)
    clean = {k: prose(rng, rng.randint(80, 200)) for k in range(60)}
    passage, leak = prose(rng, 70), prose(rng, 30)
    rows = list(clean.items())
    rows += [(100, clean[3]), (101, clean[3]), (200, "short"), (201, None), (202, "a b c " * 40)]
    rows += [(300, prose(rng, 60) + " " + passage + " " + prose(rng, 60)), (301, prose(rng, 70) + " " + passage), (400, prose(rng, 60) + " " + leak + " " + prose(rng, 50))]
    docs = documents(spark, rows, extra=False)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    every = sorted([*clean, 100, 101, 300, 301, 400])
    steps = dict(corpus_pipeline.STAGES)
    at = steps["quality_rules"](spark, at, str(tmp_path))
    assert ids(at) == every and at.columns == docs.columns
    at = steps["near_duplicates"](spark, at, str(tmp_path))
    assert ids(at) == sorted(set(every) - {100, 101}) and sorted(at.columns) == sorted(docs.columns)
    at = steps["repeated_passages"](spark, at, str(tmp_path))
    text = {r["doc_id"]: r["text"] for r in at.collect()}
    assert passage[20:-20] not in text[300] and passage[20:-20] not in text[301] and all(text[k] == t for k, t in clean.items())
    at = steps["benchmark_leaks"](spark, at, str(tmp_path))
    assert ids(at) == sorted(set(every) - {100, 101, 400}) and sorted(at.columns) == sorted(docs.columns)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(every) - {100, 101, 400}
