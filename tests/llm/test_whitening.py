import numpy as np
import pytest

from wordloom.llm.whitening import Spectrum, deviations, fitted_spectrum, rank_one, whiten, whole_numbers

SCHEMA = "vec_id long, embedding array<float>, label int, x string, part int, n long"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("seed", range(60))
def test_rank_one_updates_with_and_without_deflation(seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 14))
    d = np.sort(rng.integers(0, 4, k).astype(float)) if seed % 2 else np.sort(rng.random(k))
    if seed % 5 == 0:
        d[:] = 0
    if seed % 11 == 0:
        d = 1 + d * 1e-14
    u, _ = np.linalg.qr(rng.normal(size=(k, k)))
    v = u[:, rng.integers(0, k)].copy() if seed % 3 == 0 else rng.normal(size=k)
    v *= 1e-9 if seed % 7 == 0 else 1
    rho = float(rng.random() * 3)
    want = u @ np.diag(d) @ u.T + rho * np.outer(v, v)
    value, vector = rank_one(d, u, v, rho)
    assert np.abs(vector @ np.diag(value) @ vector.T - want).max() < 1e-12
    assert np.abs(vector.T @ vector - np.eye(k)).max() < 1e-12
    assert np.abs(value - np.linalg.eigvalsh(want)).max() < 1e-12 and (np.diff(value) >= 0).all()


@pytest.mark.parametrize("block", (1, 5, 8, 9, 400))
def test_spectrum_is_that_of_all_vectors_in_any_blocks(block):
    rng = np.random.default_rng(block)
    x = rng.integers(-30, 30, (400, 8)) @ rng.integers(-2, 3, (8, 8))
    parts = [Spectrum.empty(8) for _ in range(3)]
    for at in range(0, 400, block):
        parts[at % 3].add(x[at : at + block])
    whole = Spectrum.empty(8)
    for p in parts:
        whole.join(Spectrum.of(*p.record()))
    c = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    assert whole.n == 400 and (whole.sums == x.sum(axis=0)).all()
    assert np.abs(whole.u @ np.diag(whole.d) @ whole.u.T - c).max() < 1e-11 * np.abs(c).max()


def test_levels_of_combining(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).astype("float32").tolist()) for i in range(300)]
    fit = whole_numbers(table(spark, rows, 9)).select("x").distinct().repartition(9)
    a, b = fitted_spectrum(fit, 4, block=3, fan=2), fitted_spectrum(fit, 4)
    assert a.n == b.n and (a.sums == b.sums).all() and np.abs(a.d - b.d).max() < 1e-9 * b.d.max()


def check(spark, rows, parts=3):
    """Against a plain eigendecomposition of the covariance of the distinct vectors."""
    good = [(i, np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all()]
    fit = np.unique(np.stack([x for _, x in good]), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (fit - s / n).T @ (fit - s / n) / n
    value, vector = np.linalg.eigh(c)
    value, vector = value[::-1], vector[:, ::-1]
    got = whiten(table(spark, rows, parts)).toPandas()
    k = got["component"].max()
    assert len(got) == len(good) * k and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    for j, g in got.groupby("component"):
        assert np.abs(g["explained"] / (value[j - 1] / np.trace(c)) - 1).max() < 1e-9
        # Rows of one vec_id go by value; the sign is one for all rows.
        want = sorted((-1 if i is None else i, sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s)), float((x - s / n) @ vector[:, j - 1] / np.sqrt(value[j - 1]))) for i, x in good)
        mine = sorted((-1 if i != i else int(i), int(d), float(w)) for i, d, w in zip(g["vec_id"], g["deviation"], g["whitened"]))
        assert [m[:2] for m in mine] == [w[:2] for w in want]
        spot = np.argmax([abs(w[2]) for w in want])
        sign = np.sign(mine[spot][2] * want[spot][2])
        assert max(abs(sign * m[2] - w[2]) for m, w in zip(mine, want)) < 1e-6
    return got


def test_against_plain_eigenvectors(spark):
    rng = np.random.default_rng(7)
    mix = rng.normal(size=(20, 20))
    rows = [(i, (rng.normal(size=20) @ mix).astype("float32").tolist()) for i in range(250)]
    got = check(spark, rows, 5)
    assert got["component"].max() == 16


def test_copies_ties_nulls_and_unusable_rows(spark):
    rng = np.random.default_rng(8)
    base = [(i, rng.normal(size=3).astype("float32").tolist()) for i in range(40)]
    hot = [(100 + i, base[0][1]) for i in range(60)] + [(5, base[3][1]), (None, base[4][1])]
    bad = [(900, None), (901, [1.0, None, 2.0]), (902, [float("nan"), 1.0, 1.0]), (903, [1.0, float("inf"), 0.0])]
    check(spark, base + hot + bad)
    assert whiten(table(spark, [*base, (904, []), (905, [1.0]), (906, [3e38, 0.0, 0.0])])).where("vec_id > 903").count() == 0


def test_directions_without_variance_and_empty_tables(spark):
    rng = np.random.default_rng(9)
    flat = [(i, [float(a), 2 * float(a), 1.0]) for i, a in enumerate(rng.integers(-9, 9, 30))]
    assert {r["component"] for r in whiten(table(spark, flat)).collect()} == {1}
    assert whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whiten(table(spark, [])).count() == 0


def test_deviations_beyond_a_long_are_null():
    x = np.array([[2**40, 0], [1, 0], [2**20, 0]])
    assert deviations(x, 3, x.sum(axis=0)) == [None, None, None]
    assert deviations(x[1:], 2, x[1:].sum(axis=0)) == [(2 - 2**20 - 1) ** 2, (2**21 - 2**20 - 1) ** 2]
    assert deviations(np.array([[3, 4]]), 5, np.array([5, 5])) == [10**2 + 15**2]
