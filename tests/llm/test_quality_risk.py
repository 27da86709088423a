"""The risk-controlled cutoffs: the exact bound recomputed by hand on the held-out half, and false rejections on fresh rows."""

from fractions import Fraction
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import quality as Q

STRATA = ("en", "de", Q.NO_STRATUM)


def table(spark, rng, n, share_bad):
    """Counts of documents: good ones have few signs, some of them by chance many; bad ones mostly many."""
    rows = []
    for i in range(n):
        bad = rng.random() < share_bad
        words = 200
        symbols = int(rng.exponential(60 if bad else 3))
        capitals = int(rng.exponential(150 if bad and rng.random() < 0.5 else 20))
        rows.append((i, STRATA[int(rng.integers(3))], int(rng.integers(1 << 60)), words, 1000, symbols, 0, 0, capitals, 5, 10, 3, not bad))
    return spark.createDataFrame(rows, "doc_id long, stratum string, text_id long, " + ", ".join(f"{c} long" for c in Q.COUNTS) + ", good boolean")


def exact_cdf(k, n, p):
    p = Fraction(p)
    return float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


@pytest.mark.parametrize(("k", "n", "p"), [(0, 50, 0.02), (3, 400, 0.02), (10, 900, 0.02), (7, 20, 0.5)])
def test_binomial_against_fractions(k, n, p):
    assert abs(Q.binomial_cdf(k, n, p) - exact_cdf(k, n, p)) < 1e-12


@pytest.mark.parametrize("seed", range(3))
def test_cutoffs_hold_their_bound(spark, seed):
    rng = np.random.default_rng(seed)
    feats = table(spark, rng, 6000, 0.25)
    labels = feats.select("doc_id", F.col("good").cast("int").alias("quality"))
    cutoffs = Q.select_cutoffs(feats.drop("good"), labels)
    assert cutoffs and set(cutoffs) <= set(STRATA)
    held = feats.where("good").where(F.pmod(F.xxhash64("text_id"), F.lit(2)) == 0)
    fresh = table(spark, rng, 12_000, 0.25)
    for stratum, rules in cutoffs.items():
        for m in range(1, len(rules) + 1):
            rejects = None
            for name, cut in rules[:m]:
                hit = F.expr(Q.RULES[name]) > cut
                rejects = hit if rejects is None else rejects | hit
            n, k = held.where(F.col("stratum") == stratum).agg(F.count("*"), F.count_if(rejects)).first()
            assert exact_cdf(k, n, Q.ALPHA) <= Q.DELTA / len(cutoffs)
        good, lost, bad, caught = fresh.where(F.col("stratum") == stratum).agg(F.count_if("good"), F.count_if(F.col("good") & rejects), F.count_if(~F.col("good")), F.count_if(~F.col("good") & rejects)).first()
        assert lost <= 1.5 * Q.ALPHA * good and caught > 0.3 * bad


def test_too_few_labels_give_no_cutoff(spark):
    feats = table(spark, np.random.default_rng(9), 200, 0.25)
    assert Q.select_cutoffs(feats.drop("good"), feats.select("doc_id", F.col("good").cast("int").alias("quality"))) == {}
