import random

from pyspark.sql import functions as F

from tests.llm._rows import awkward, documents, prose
from wordloom.llm.quality import binomial_cdf, judge, keep, text_counts

WS = " \t\n\r\x0b\x0c"


def slow_counts(text):
    text = text or ""
    words, cur = [], ""
    for c in text + " ":
        if c in WS:
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    win = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(win) if win.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(WS)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_counts_against_brute_force():
    rng = random.Random(1)
    texts = [t for _, t in awkward(2, 500)] + ["a b c a b c", "a a a a", "x\nx\n\nx\n y", "\n\n"] + [" ".join(rng.choice("abc") for _ in range(60)) for _ in range(20)]
    for t in texts:
        assert text_counts(t)[:5] == slow_counts(t)


def test_exact_binomial():
    assert abs(binomial_cdf(1, 3, 0.5) - 0.5) < 1e-12 and binomial_cdf(3, 3, 0.1) == 1 and abs(binomial_cdf(0, 300, 0.02) - 0.98**300) < 1e-12


def test_junk_goes_and_clean_stays(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(1600):
        bad = k % 4 == 0
        text = prose(rng, 60)
        rows.append((k, text.replace(" ", "### ") if bad else text, "en" if k % 2 else None))
        if k < 1400:
            labels.append((k, 0 if bad else 1))
    labels += [(None, 1), (5, None), (999_999, 0)]
    rows += [(d + 10_000, t) for d, t in awkward(4, 300)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in judge(documents(spark, rows), lab).collect()}
    assert len(got) == len(rows)
    for k in range(1600):
        assert got[k]["kept"] == (k % 4 != 0)
    assert got[10_000]["base_failed"] and not got[10_000]["kept"]
    few = judge(documents(spark, rows), lab.limit(0))
    assert few.where("kept = base_failed").count() == 0
    assert judge(documents(spark, []), lab).count() == 0


def test_keep_decides_row_by_row(spark):
    rng = random.Random(5)
    good = prose(rng, 120)
    rows = [(1, good), (1, good), (1, "short"), (None, good), (None, None), (2, "a b c " * 40), (3, prose(rng, 20_000))]
    docs = documents(spark, rows).withColumn("n_words", F.lit("x")).withColumn("stratum", F.lit(1.5))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = keep(docs, labels)
    assert got.columns == docs.columns and sorted((r["doc_id"] or 0, r["text"]) for r in got.collect()) == sorted([(1, good), (1, good), (0, good), rows[-1]])
    assert keep(documents(spark, []), labels).count() == 0
