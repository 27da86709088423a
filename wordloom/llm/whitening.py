"""Whitening by an incremental eigendecomposition.

Each entry c of a vector becomes the whole number ``floor(64 * c)`` (the contract's ``+ 1000000`` shifts every entry and so no deviation from a mean).
The fit list holds each different whole-number vector once. Every partition of it keeps a spectrum: count, exact sums, eigenvalues and eigenvectors of its
scatter, changed by centred rank-one updates that solve the secular equation with deflation. A block of more vectors than dimensions is first turned into
as many centred vectors as dimensions, the rows of its triangular factor, which have the same scatter, and one more for the shift of the mean. Spectra are
combined in groups of ``FAN`` by successive rank-one updates, level by level, until ``FAN`` or fewer (some D * D numbers each) reach the driver. A distributed
Rayleigh-Ritz pass over the fit list then gives the scatter in the basis found, whose small eigenproblem yields the components to double precision, and one
more pass measures the whitened covariance against the identity. What is shuffled besides the distinct vectors is D * D numbers a task.

Rows: a null vector, or one with a null, NaN or infinite entry or one beyond ``LARGEST``, is left out, as are vectors whose length isn't the most common one
(the longer of two equally common) and empty ones. Repeated rows and null vec_ids get their rows each; ties of eigenvalues take any orthonormal basis.
Directions without variance (up to rounding) have no component, so a fit list of one vector, and an empty table, give an empty result.
A deviation beyond a long is null. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import staged

SCALE, COMPONENTS, BLOCK, FAN = 64, 16, 4096, 16
#: Entries beyond this have no exact whole number.
LARGEST = 2.0**40

_EPS = float(np.finfo(np.float64).eps)
_STEPS = 100


def secular_roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """``W[i, j] = root_j - d_i`` for the roots of ``1 + sum(z2_i / (d_i - x))``; ``d`` rises strictly, all ``z2`` are positive.

    Root j lies between d_j and d_j+1, the last one within ``sum(z2)`` above d_last. Each is sought as its distance from the nearer pole, by a rational
    interpolation that keeps both neighbouring poles, inside a bracket that is halved wherever a step leaves it.
    """
    k = len(d)
    above = np.append(d[1:], d[-1] + 2 * z2.sum())
    width = above - d
    col = np.arange(k)
    low_side = col[:, None] <= col[None, :]  # poles up to root j
    middle = d + width / 2
    at_middle = 1 + (z2[:, None] / (d[:, None] - middle)).sum(axis=0)
    left = (at_middle >= 0) | (col == k - 1)
    origin = np.where(left, d, above)
    delta = d[:, None] - origin
    p1, p2 = d - origin, above - origin
    lo = np.where(left, 0.0, -width / 2)
    hi = np.where(left, np.where(col == k - 1, width, width / 2), 0.0)
    mu = (lo + hi) / 2
    for _ in range(_STEPS):
        gap = delta - mu
        term = z2[:, None] / gap
        slope = term / gap
        psi, phi = np.where(low_side, term, 0).sum(axis=0), np.where(low_side, 0, term).sum(axis=0)
        dpsi, dphi = np.where(low_side, slope, 0).sum(axis=0), np.where(low_side, 0, slope).sum(axis=0)
        f = 1 + psi + phi
        lo, hi = np.where(f < 0, mu, lo), np.where(f > 0, mu, hi)
        done = (np.abs(f) <= 4 * _EPS * k * (1 + np.abs(psi) + phi)) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if done.all():
            break
        d1, d2 = p1 - mu, p2 - mu
        a, b, c = (d1 + d2) * f - d1 * d2 * (dpsi + dphi), d1 * d2 * f, f - d1 * dpsi - d2 * dphi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        to = mu + step
        inside = np.isfinite(to) & (to > lo) & (to < hi)
        mu = np.where(done, mu, np.where(inside, to, (lo + hi) / 2))
    return mu - delta


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``u diag(d) u' + rho v v'``; ``d`` rises, ``rho >= 0``.

    Deflation: poles that agree to rounding are turned within their own space so that one of them carries all of v, and poles that v hardly touches keep their pair.
    """
    z = u.T @ v
    weight = rho * float(z @ z)
    if weight <= 0:
        return d, u
    tol = 8 * _EPS * max(abs(d[-1]), weight)
    edges = np.flatnonzero(np.diff(d) > tol) + 1
    bounds = [0, *edges.tolist(), len(d)]
    if len(bounds) - 1 < len(d):
        u, z = u.copy(), z.copy()
        for lo, hi in zip(bounds, bounds[1:]):
            if hi - lo > 1 and (norm := float(np.linalg.norm(z[lo:hi]))) > 0:
                mirror = z[lo:hi].copy()
                sign = 1.0 if mirror[-1] >= 0 else -1.0
                mirror[-1] += sign * norm
                mirror /= np.linalg.norm(mirror)
                u[:, lo:hi] -= 2 * np.outer(u[:, lo:hi] @ mirror, mirror)
                z[lo:hi] = 0
                z[hi - 1] = -sign * norm
    live = rho * np.abs(z) * np.sqrt(weight / rho) > tol
    if not live.any():
        return d, u
    dk, zk = d[live], z[live]
    w = secular_roots(dk, rho * zk * zk)
    # The vector for which the roots found are exact; its eigenvectors are orthogonal whatever the roots' rounding.
    k = len(dk)
    col = np.arange(k)
    below = col[None, :] < col[:, None]
    bottom = np.where(below, dk[None, :] - dk[:, None], np.append(dk[1:], 0.0)[None, :] - dk[:, None])
    bottom[:, -1] = np.where(below[:, -1], bottom[:, -1], 1.0)
    # The last root has no pole above it; below the diagonal every root is paired with its own pole.
    ratio = w / bottom
    exact = np.sqrt(np.abs(ratio.prod(axis=1)) / rho) * np.where(zk < 0, -1.0, 1.0)
    q = exact[:, None] / -w
    q /= np.linalg.norm(q, axis=0)
    out_d, out_u = d.copy(), u.copy()
    out_d[live] = dk + np.diagonal(w)
    out_u[:, live] = u[:, live] @ q
    order = np.argsort(out_d, kind="stable")
    return out_d[order], out_u[:, order]


@dataclass
class Spectrum:
    """Count, exact sums, and the eigenpairs of the scatter about the mean."""

    n: int
    sums: np.ndarray
    d: np.ndarray
    u: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims, dtype=np.int64), np.zeros(dims), np.eye(dims))

    def _shifted(self, n: int, sums: np.ndarray) -> None:
        """The rank-one part that joining ``n`` vectors of these sums owes to their mean."""
        if self.n:
            self.d, self.u = rank_one(self.d, self.u, sums / n - self.sums / self.n, self.n * n / (self.n + n))
        self.n, self.sums = self.n + n, self.sums + sums

    def add(self, x: np.ndarray) -> None:
        """Whole-number vectors, one a row."""
        n, dims = x.shape
        if n <= dims:
            for row in x:
                self._shifted(1, row)
            return
        sums = x.sum(axis=0)
        for row in np.linalg.qr(x - sums / n, mode="r"):
            self.d, self.u = rank_one(self.d, self.u, row, 1.0)
        self._shifted(n, sums)

    def join(self, other: Spectrum) -> None:
        if self.n == 0:
            self.n, self.sums, self.d, self.u = other.n, other.sums, other.d, other.u
        elif other.n:
            for value, vector in zip(other.d, other.u.T):
                if value > 0:
                    self.d, self.u = rank_one(self.d, self.u, vector, float(value))
            self._shifted(other.n, other.sums)

    def record(self) -> tuple[int, list[int], bytes, bytes]:
        return self.n, self.sums.tolist(), self.d.tobytes(), np.ascontiguousarray(self.u).tobytes()

    @classmethod
    def of(cls, n: int, sums: list[int], d: bytes, u: bytes) -> Spectrum:
        dims = len(sums)
        return cls(int(n), np.array(sums, dtype=np.int64), np.frombuffer(d), np.frombuffer(u).reshape(dims, dims))


_SPECTRUM = "part int, n long, sums array<long>, d binary, u binary"


def whole_numbers(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id and x, the entries as whole numbers, of rows with usable vectors of the common length."""
    c = F.col(vector).cast("array<double>")
    usable = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= LARGEST)) & (F.size(c) > 0)
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(key).cast("long").alias("vec_id"), F.transform(c, lambda e: F.floor(e * SCALE).cast("long")).alias("x"))
    common = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return rows.where(F.size("x") == (common["dims"] if common else 0))


def matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def fitted_spectrum(fit: DataFrame, dims: int, block: int = BLOCK, fan: int = FAN) -> Spectrum:
    """The spectrum of all vectors of ``fit`` (x array<long>)."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(dims)
        for batch in batches:
            x = matrix(batch, 0) if batch.num_rows else np.zeros((0, dims), dtype=np.int64)
            for at in range(0, len(x), block):
                own.add(x[at : at + block])
        if own.n:
            columns = [[TaskContext.get().partitionId()], *([v] for v in own.record())]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], type=pa.int32()), pa.array(columns[1], type=pa.int64()), pa.array(columns[2], type=pa.list_(pa.int64())), pa.array(columns[3], type=pa.binary()), pa.array(columns[4], type=pa.binary())], names=["part", "n", "sums", "d", "u"])

    def joined(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        own = Spectrum.empty(dims)
        for r in group.sort_values("part").itertuples():
            own.join(Spectrum.of(r.n, list(r.sums), r.d, r.u))
        return pd.DataFrame([(int(keys[0]), *own.record())], columns=["part", "n", "sums", "d", "u"])

    spectra = staged(fit.select("x").mapInArrow(grow, _SPECTRUM), "spectra")
    while (spectra.agg(F.max("part")).first()[0] or 0) >= fan:
        spectra = staged(spectra.groupBy(F.floor(F.col("part") / fan).cast("int").alias("g")).applyInPandas(joined, _SPECTRUM), "spectra")
    total = Spectrum.empty(dims)
    for r in sorted(spectra.collect(), key=lambda r: r["part"]):
        total.join(Spectrum.of(r["n"], r["sums"], bytes(r["d"]), bytes(r["u"])))
    return total


def summed_products(fit: DataFrame, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The sum over ``fit`` of ``y y'`` with ``y = basis' (x - mean)``: one partial matrix a task, added up cell by cell."""
    k = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                y = (matrix(batch, 0) - mean) @ basis
                own += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k, dtype=np.int32)), pa.array(own.ravel())], names=["cell", "value"])

    out = np.zeros(k * k)
    for r in fit.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[r["cell"]] = r["value"]
    return (out.reshape(k, k) + out.reshape(k, k).T) / 2


def components(fit: DataFrame, spectrum: Spectrum, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues and unit eigenvectors of the covariance, falling, and its trace, by Rayleigh-Ritz in the spectrum's basis."""
    basis, _ = np.linalg.qr(spectrum.u[:, ::-1])
    scatter = summed_products(fit, spectrum.sums / spectrum.n, basis) / spectrum.n
    value, turn = np.linalg.eigh(scatter)
    value, turn = value[::-1], turn[:, ::-1]
    real = int((value > len(value) * _EPS * max(value[0], 0)).sum())
    keep = min(most, real)
    return value[:keep], (basis @ turn)[:, :keep], float(np.trace(scatter))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum over dimensions of ``(n * x - sums) ** 2``, exact."""
    bound = (n * np.abs(x).max(initial=0).astype(float) + np.abs(sums).max(initial=0).astype(float)) ** 2 * x.shape[1]
    if bound < 2.0**62:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist())) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, vector, key)
    fit = staged(rows.select("x").distinct(), "whitening-fit")
    one = fit.first()
    if one is None:
        return spark.createDataFrame([], schema)
    spectrum = fitted_spectrum(fit, len(one["x"]))
    n, sums = spectrum.n, spectrum.sums
    value, vector_of, trace = components(fit, spectrum, most)
    k = len(value)
    if k == 0:
        return spark.createDataFrame([], schema)
    to_white, mean = vector_of / np.sqrt(value), sums / n
    error = float(np.abs(summed_products(fit, mean, to_white) / n - np.eye(k)).max())
    explained = value / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, m = matrix(batch, 1), batch.num_rows
                each = np.repeat(np.arange(m), k)
                out = [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(deviations(x, n, sums), type=pa.int64()).take(pa.array(each))]
                out += [pa.array(((x - mean) @ to_white).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays(out, names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(run, schema)
