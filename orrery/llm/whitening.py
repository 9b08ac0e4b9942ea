"""Whitening of embeddings by incremental eigendecomposition.

Each partition keeps the spectrum of its own scatter matrix and adds one vector at a
time: a centred rank-one update whose new eigenvalues are the roots of the secular
equation, after deflation of what the update does not touch. Spectra of partitions are
combined, in two levels on the executors, by successive rank-one updates with the
eigenvectors of the other side and with the difference of the means. The basis that
comes out is refined by one distributed Rayleigh-Ritz step: the covariance of all
vectors in that basis is summed exactly centred, and its small eigenproblem turns the
basis into eigenvectors to working precision.

Only one spectrum, its size set by the dimension alone, reaches the driver.

Defined results. A row whose vector is null, or holds a null, a NaN, an infinity or a
number whose 1024-fold is beyond 2**62, is dropped, and so is one whose length is not
that of most vectors (the shorter of two equally frequent ones counts). Repeated rows
and ids, and rows without an id, are all fitted and returned. A component without
variance, or less than RELATIVE_ZERO of all, is not returned, so that one vector, or
equal ones, give no rows. ``deviation`` is null where it is beyond a long. Columns of
any other name are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components returned at most.
COMPONENTS = 8
#: Fixed values of the contract: entries are scaled, floored and shifted.
SCALE, SHIFT = 1024.0, 100_000
#: Share of all variance below which a component counts as none.
RELATIVE_ZERO = 1e-12
#: Tasks that combine the results of all partitions before the last one does.
FAN = 64
#: A root of the secular equation is taken where rounding hides what is left, or after
#: a step of this relative size.
ROUNDING, LAST_STEP = 4 * np.finfo(float).eps, 1e-6


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum w[j] / (d[j] - x) for ascending ``d`` and positive ``w``.

    Root i lies between d[i] and d[i + 1]. Returned as the nearer pole's index and the
    distance from that pole, which keeps close roots accurate. The two sides of the
    sum are each replaced by one pole with the same value and slope, whose root is the
    next guess; a bracket keeps guesses in order.
    """
    k = len(d)
    total = w.sum()
    right = np.append(d[1:], d[-1] + 2 * total)  # a bound beyond the last root
    i = np.arange(k)
    middle = (d + right) / 2
    f = 1 + (w / (d - middle[:, None])).sum(axis=1)
    near = np.where((f >= 0) | (i == k - 1), i, i + 1)
    delta = d - d[near][:, None]
    low = np.where(near == i, 0.0, (d - right) / 2)
    high = np.where(near == i, np.where(f >= 0, (right - d) / 2, right - d), 0.0)
    low = np.where((near == i) & (f < 0), (right - d) / 2, low)
    x = (low + high) / 2
    pole, beyond = delta[i, i], np.append(delta[i[:-1], i[1:]], 0.0)
    left = np.tril(np.ones((k, k)))
    active = i
    for _ in range(60):
        p, q, at = pole[active] - x[active], beyond[active] - x[active], left[active]
        part = delta[active] - x[active, None]
        np.divide(w, part, out=part)
        slope = part * part / w
        psi, dpsi = np.einsum("ij,ij->i", part, at), np.einsum("ij,ij->i", slope, at)
        phi, dphi = part.sum(axis=1) - psi, slope.sum(axis=1) - dpsi
        f = 1 + psi + phi
        low[active], high[active] = np.where(f < 0, x[active], low[active]), np.where(f < 0, high[active], x[active])
        # 1 + s + r / (pole - y) + t / (beyond - y) = 0
        c = 1 + psi - dpsi * p + phi - dphi * q
        r, t = dpsi * p * p, dphi * q * q
        a1 = c * (p + q) + r + t
        a0 = c * p * q + r * q + t * p
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a1 * a1 - 4 * c * a0, 0.0))
            y1, y2 = 2 * a0 / (a1 + root), 2 * a0 / (a1 - root)
            y = np.where((y1 > p) & (y1 < q), y1, y2)
            if active[-1] == k - 1:
                y[-1] = p[-1] + r[-1] / (1 + psi[-1] - dpsi[-1] * p[-1])
        new = x[active] + y
        bad = ~(new > low[active]) | ~(new < high[active])
        new[bad] = (low[active][bad] + high[active][bad]) / 2
        exact = np.abs(f) <= ROUNDING * k * (1 + np.abs(psi) + np.abs(phi))
        # Steps shrink quadratically, so the one after a small one is below rounding.
        settled = exact | (np.abs(new - x[active]) <= np.where(bad, ROUNDING, LAST_STEP) * np.abs(new))
        x[active[~exact]] = new[~exact]
        active = active[~settled]
        if not len(active):
            break
    return near, x


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``vectors @ diag(values) @ vectors.T + rho * v v'``, ascending."""
    z = vectors.T @ v
    weight = rho * (z @ z)
    if not weight > 0:
        return values, vectors
    tiny = 8 * np.finfo(float).eps * max(float(np.abs(values).max()), weight)
    # Equal eigenvalues: a reflection turns all of the update into the last of them.
    close = np.diff(values) <= tiny
    if close.any():
        vectors = vectors.copy()
        edges = np.flatnonzero(np.append(True, ~close))
        for a, b in zip(edges, np.append(edges[1:], len(values))):
            if b - a > 1 and (size := np.linalg.norm(z[a:b])) > 0:
                u = z[a:b].copy()
                u[-1] += np.copysign(size, u[-1])
                u /= np.linalg.norm(u)
                vectors[:, a:b] -= np.outer(2 * (vectors[:, a:b] @ u), u)
                z[a : b - 1], z[b - 1] = 0.0, -np.copysign(size, z[b - 1])
    moved = rho * np.abs(z) * np.sqrt(z @ z) > tiny
    k = np.flatnonzero(moved)
    if not len(k):
        return values, vectors
    d, zk = values[k], z[k]
    near, x = secular_roots(d, rho * zk * zk)
    found = d[near] + x
    # distance[i, j]: root i minus pole j.
    distance = x[:, None] - (d - d[near][:, None])
    # The update whose roots these are exactly, so that the new vectors are orthogonal.
    between = d[None, :] - d[:, None]
    np.fill_diagonal(between, 1.0)
    ratio = distance / between.T
    ratio[np.diag_indices(len(k))] = np.diag(distance)
    exact = np.sqrt(np.abs(np.prod(ratio, axis=0))) * np.sign(zk)
    turn = exact[None, :] / distance
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    values, vectors = values.copy(), vectors.copy()
    values[k], vectors[:, k] = found, vectors[:, k] @ turn.T
    by = np.argsort(values, kind="stable")
    return values[by], vectors[:, by]


class Spectrum:
    """Count, mean, and eigenvalues and vectors of the scatter about the mean."""

    def __init__(self, dim: int):
        self.n, self.mean = 0, np.zeros(dim)
        self.values, self.vectors = np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        self.n += 1
        away = x - self.mean
        if self.n > 1:
            self.values, self.vectors = rank_one(self.values, self.vectors, (self.n - 1) / self.n, away)
        self.mean = self.mean + away / self.n

    def absorb(self, other: Spectrum) -> None:
        """Becomes the spectrum of both sides' vectors."""
        if not other.n:
            return
        both, away = self.n + other.n, other.mean - self.mean
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, value, vector)
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / both, away)
        self.mean = self.mean + away * (other.n / both)
        self.n = both

    def row(self) -> list[float]:
        return [float(self.n), *self.mean, *self.values, *self.vectors.ravel()]

    @classmethod
    def of_row(cls, row: np.ndarray, dim: int) -> Spectrum:
        out = cls(dim)
        out.n, out.mean, out.values = int(row[0]), row[1 : 1 + dim], row[1 + dim : 1 + 2 * dim]
        out.vectors = row[1 + 2 * dim :].reshape(dim, dim)
        return out


def _matrix(batch: pa.RecordBatch, column: int, dim: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(-1, dim)


def _one_row(name: str, value: np.ndarray | list[float]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.asarray(value, float)], pa.list_(pa.float64()))], names=[name])


def _combined(parts: DataFrame, name: str, combine) -> np.ndarray | None:
    """The rows of ``parts`` (an array column ``name``, one row per partition) combined
    by ``combine`` (arrays to array) in FAN tasks and then in one."""

    def run(table: pa.Table) -> pa.Table:
        rows = [np.asarray(x.values) for x in table[name].combine_chunks()]
        return pa.Table.from_batches([_one_row(name, combine(rows))])

    schema = f"{name} array<double>"
    some = parts.groupBy((F.spark_partition_id() % FAN).alias("_of")).applyInArrow(run, schema)
    last = some.groupBy(F.lit(0).alias("_of")).applyInArrow(run, schema).first()
    return None if last is None else np.array(last[name])


def _total(rows: list[np.ndarray]) -> np.ndarray:
    return np.sum(rows, axis=0)


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the whole numbers that are fitted, of the rows that count."""
    entry = lambda c: c.cast("double") * SCALE
    sound = lambda c: F.coalesce(F.abs(entry(c)) < 2.0**62, F.lit(False))  # noqa: E731  (false for NaN, which is largest)
    rows = vectors.where("embedding is not null and size(embedding) > 0").where(F.forall("embedding", sound))
    whole = lambda c: F.when(sound(c), F.floor(entry(c)).cast("long") + SHIFT)
    return rows.select("vec_id", F.transform("embedding", whole).alias("x"))


def fit(rows: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray] | None:
    """Count, sums per dimension, eigenvalues (falling) and eigenvectors (columns) of the
    covariance of ``x``, by the incremental basis and its Rayleigh-Ritz refinement."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(dim)
        for batch in batches:
            for x in _matrix(batch, 0, dim) - SHIFT:
                own.add(x.astype(float))
        if own.n:
            yield _one_row("spectrum", own.row())

    def join(parts: list[np.ndarray]) -> list[float]:
        out = Spectrum.of_row(parts[0], dim)
        for part in parts[1:]:
            out.absorb(Spectrum.of_row(part, dim))
        return out.row()

    x = rows.select("x")
    sums = x.select(F.posexplode("x").alias("k", "c")).groupBy("k").agg(F.sum("c").alias("s"), F.count("*").alias("n")).orderBy("k").collect()
    row = _combined(x.mapInArrow(grow, "spectrum array<double>"), "spectrum", join)
    if row is None:
        return None
    n, total = int(sums[0]["n"]), np.array([r["s"] for r in sums], np.int64)
    basis, _ = np.linalg.qr(Spectrum.of_row(row, dim).vectors)

    def ritz(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((dim, dim))
        for batch in batches:
            y = centred(_matrix(batch, 0, dim), n, total) @ basis
            out += y.T @ y
        yield _one_row("h", out.ravel())

    h = _combined(x.mapInArrow(ritz, "h array<double>"), "h", _total).reshape(dim, dim) / n
    values, turn = np.linalg.eigh((h + h.T) / 2)
    return n, total, np.maximum(values[::-1], 0.0), (basis @ turn)[:, ::-1]


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x minus the mean, from whole numbers."""
    return (x * n - total) / n


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per kept row and component: vec_id, component (from 1), n, deviation,
    whitened, explained and identity_error."""
    kind = dict(vectors.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = scaled(vectors)
    most = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if most is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dim = int(most["dim"])
    rows = rows.where(F.size("x") == dim)
    n, total, values, basis = fit(rows, dim)
    trace = values.sum()
    k = int(np.sum(values[:components] > RELATIVE_ZERO * trace))
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    project = basis[:, :k] / np.sqrt(values[:k])
    share = values[:k] / trace

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, mean = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            w = centred(_matrix(batch, 0, dim), n, total) @ project
            out, mean = out + w.T @ w, mean + w.sum(axis=0)
        yield _one_row("m", np.concatenate([mean, out.ravel()]))

    m = _combined(rows.select("x").mapInArrow(moments, "m array<double>"), "m", _total) / n
    error = float(np.abs(m[k:].reshape(k, k) - np.outer(m[:k], m[:k]) - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, 1, dim)
            whole = x * n - total
            size = (whole.astype(float) ** 2).sum(axis=1)
            deviation = (whole * whole).sum(axis=1)  # exact where it fits a long
            w = centred(x, n, total) @ project
            many = len(x) * k
            take = pa.array(np.repeat(np.arange(len(x)), k))
            out = [
                batch.column(0).take(take),
                pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(many, n), pa.int64()),
                pa.array(np.repeat(deviation, k), pa.int64(), mask=np.repeat(size >= 2.0**63, k)),
                pa.array(w.ravel()),
                pa.array(np.tile(share, len(x))),
                pa.array(np.full(many, error)),
            ]
            yield pa.RecordBatch.from_arrays(out, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
