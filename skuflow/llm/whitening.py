"""Embedding whitening by spectrum slicing.

Entries become integers, x = floor(1024 c) + 100000.  The rows' count and sums are
exact; the covariance is summed from centred rows, a partial matrix per task.  Its
leading eigenvalues are found by slicing: an LDL' factorisation of V - s I (symmetric
pivoting, blocks of one or two) has as many negative pivots as V has eigenvalues below
s, so bisecting s isolates each wanted one between two counts.  From inside its
interval Rayleigh quotient iteration converges cubically; a step that leaves the
interval is thrown away and the interval halved.  Two more counts on either side of
the result certify that it is the eigenvalue of that number.  Eigenvalues too close to
be told apart are taken as one cluster, by inverse iteration on a block.

Only matrices as wide as a vector reach the driver.  Vectors are read three times
(sums, covariance, projection); the projected rows are written and give the error of
the identity.

Cases: a row whose vector is null, empty, holds null or non-finite entries, or one of
LIMIT and more (its integers would not be exact), is dropped; vectors of each length are
fitted and whitened among themselves; a component of no variance (an eigenvalue within
rounding of 0) has no whitened value (null) and explains 0; a vector shorter than the
number of components gives as many as it has entries; null ids, repeated rows and
further columns are fine; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import ship, written

SCALE, SHIFT = 1024, 100_000
#: Entries from here on are dropped: x stays below 2**42.
LIMIT = float(1 << 31)
#: Eigenvalues closer than this share of the largest one are one cluster.
CLOSE = 1e-9


# --- the spectrum of one matrix -----------------------------------------------

def negatives(a: np.ndarray) -> int:
    """Negative eigenvalues of the symmetric ``a``: negative pivots of its LDL' factorisation
    (Bunch-Kaufman pivoting; an exact zero pivot counts as positive)."""
    a = a.copy()
    n, k, count = len(a), 0, 0
    alpha = (1 + np.sqrt(17)) / 8
    while k < n:
        size = 1
        if k < n - 1:
            below = np.abs(a[k + 1:, k])
            r = k + 1 + int(below.argmax())
            top = below[r - k - 1]
            if top > 0 and abs(a[k, k]) < alpha * top:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                widest = row.max()
                if abs(a[k, k]) * widest < alpha * top * top:
                    if abs(a[r, r]) >= alpha * widest:
                        _swap(a, k, r)
                    else:
                        _swap(a, k + 1, r)
                        size = 2
        if size == 1:
            pivot = a[k, k]
            count += pivot < 0
            if pivot:
                column = a[k + 1:, k].copy()
                a[k + 1:, k + 1:] -= np.outer(column / pivot, column)
        else:
            block, rest = a[k:k + 2, k:k + 2].copy(), a[k + 2:, k:k + 2].copy()
            det = block[0, 0] * block[1, 1] - block[0, 1] ** 2
            count += 1 if det < 0 else 2 * (block[0, 0] < 0)
            inverse = np.array([[block[1, 1], -block[0, 1]], [-block[0, 1], block[0, 0]]]) / det
            a[k + 2:, k + 2:] -= rest @ inverse @ rest.T
        k += size
    return int(count)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


class Spectrum:
    """The leading eigenpairs of a symmetric positive semidefinite matrix."""

    def __init__(self, matrix: np.ndarray):
        self.v = (matrix + matrix.T) / 2
        self.n = len(matrix)
        self.norm = float(np.abs(self.v).sum(1).max(initial=0.0))            # bounds every eigenvalue
        self.counts: dict[float, int] = {-self.norm * 1.01 - 1e-300: 0, self.norm * 1.01 + 1e-300: self.n}
        self.random = np.random.default_rng(5)

    def below(self, shift: float) -> int:
        """Eigenvalues below ``shift``."""
        if shift not in self.counts:
            self.counts[shift] = negatives(self.v - shift * np.eye(self.n))
        return self.counts[shift]

    def interval(self, number: int) -> tuple[float, float]:
        """The narrowest known (a, b) with eigenvalue ``number`` (from 1, falling) inside."""
        rank = self.n - number                                               # eigenvalues below it
        return max(s for s, c in self.counts.items() if c <= rank), min(s for s, c in self.counts.items() if c > rank)

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(eigenvalues, unit eigenvectors as columns) of numbers 1 to ``most``."""
        values, vectors = np.zeros(0), np.zeros((self.n, 0))
        while len(values) < min(most, self.n):
            number = len(values) + 1
            a, b = self.interval(number)
            while self.below(b) - self.below(a) > 1 and b - a > CLOSE * self.norm:
                if not a < (a + b) / 2 < b:
                    break
                self.below((a + b) / 2)
                a, b = self.interval(number)
            size = self.below(b) - self.below(a)
            if size == 1:
                value, vector = self._single(number, vectors)
                more, basis = np.array([value]), vector[:, None]
            else:
                more, basis = self._cluster((a + b) / 2, size, vectors)
            values, vectors = np.concatenate([values, more]), np.hstack([vectors, basis])
        return values[:most], vectors[:, :most]

    def _solve(self, shift: float, x: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(self.v - shift * np.eye(self.n), x)
            if np.isfinite(y).all():
                return y
        except np.linalg.LinAlgError:
            pass                                                             # the shift is an eigenvalue
        return np.linalg.solve(self.v - (shift + 4e-16 * self.norm + 1e-300) * np.eye(self.n), x)

    def _start(self, a: float, b: float, found: np.ndarray, size: int = 1) -> np.ndarray:
        x = self.random.normal(size=(self.n, size))
        for _ in range(3):                                                   # inverse iteration into the interval
            x -= found @ (found.T @ x)
            x = np.linalg.qr(self._solve((a + b) / 2, np.linalg.qr(x)[0]))[0]
        return x

    def _single(self, number: int, found: np.ndarray) -> tuple[float, np.ndarray]:
        a, b = self.interval(number)
        x = self._start(a, b, found)[:, 0]
        goal = 4e-15 * self.norm * np.sqrt(self.n)
        for _ in range(200):
            image = self.v @ x
            value = float(x @ image)
            residual = float(np.linalg.norm(image - value * x))
            if a < value < b and residual <= goal and self._certified(number, value, max(2 * residual, 1e-13 * self.norm)):
                return value, x
            if not a < value < b:                                            # it heads for another eigenvalue
                self.below((a + b) / 2)
                a, b = self.interval(number)
                x = self._start(a, b, found)[:, 0]
                continue
            y = self._solve(value, x)
            x = y / np.linalg.norm(y)
        raise ArithmeticError("an eigenvalue did not settle")

    def _certified(self, number: int, value: float, margin: float) -> bool:
        rank = self.n - number
        return self.below(value - margin) <= rank < self.below(value + margin)

    def _cluster(self, centre: float, size: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self._start(centre, centre, found, size)
        for _ in range(3):
            x = np.linalg.qr(self._solve(centre, x))[0]
        x = np.linalg.qr(x - found @ (found.T @ x))[0]
        values, turn = np.linalg.eigh(x.T @ self.v @ x)                      # as many rows as the cluster has values
        return values[::-1], x @ turn[:, ::-1]


# --- passes over the vectors ---------------------------------------------------

def _integers(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, x) for the vectors of each length in a batch of vectors without null."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    flat, starts = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        c = flat[starts[rows][:, None] + np.arange(dim)]
        yield int(dim), rows, np.floor(SCALE * c).astype(np.int64) + SHIFT


def _fit_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    own = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    fine = f"size(vector) > 0 and forall(vector, v -> v is not null and not isnan(v) and abs(v) < {LIMIT!r}D)"
    return own.where(F.expr(fine))


def _sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """dim -> (n, S), exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for dim, own, x in _integers(batch.column(0)):
                n, s = held.get(dim, (0, 0))
                held[dim] = (n + len(own), s + x.sum(0).astype(object))
        for dim, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                                              pa.array([Decimal(v) for v in s], pa.decimal128(38, 0))], ["dim", "i", "n", "s"])

    parts = rows.select("vector").mapInArrow(run, "dim int, i int, n long, s decimal(38,0)")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim", "i").collect():   # a row per entry
        out.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))
    return out


def _centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """x - S / n, from the exact n x - S."""
    return _scaled(x, n, s).astype(np.float64) / n


def _scaled(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n x - S, exact: as 64-bit integers where they hold it, else as Python's."""
    if n < 1 << 19:
        return n * x - np.array(s, np.int64)
    return n * x.astype(object) - np.array(s, object)


def _covariances(rows: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """dim -> sum over rows of centred products, divided by n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _integers(batch.column(0)):
                y = _centred(x, *sums[dim])
                held[dim] = held.get(dim, 0) + y.T @ y
        for dim, m in held.items():
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                              pa.array(m[i, j])], ["dim", "i", "j", "v"])

    parts = rows.select("vector").mapInArrow(run, "dim int, i int, j int, v double")
    out = {dim: np.zeros((dim, dim)) for dim in sums}
    for r in parts.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect():                # dim * (dim + 1) / 2 rows
        out[r["dim"]][r["i"], r["j"]] = out[r["dim"]][r["j"], r["i"]] = r["v"] / sums[r["dim"]][0]
    return out


def squares(d: np.ndarray) -> list[int]:
    """Sum of squares of each row of integers, exact."""
    if d.dtype != object and (not d.size or float(np.abs(d).max()) ** 2 * d.shape[1] < 2.0 ** 62):
        return (d * d).sum(1).tolist()
    return (d.astype(object) ** 2).sum(1).tolist()


def fit(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> dict[int, tuple]:
    """dim -> (n, S, eigenvalues, eigenvectors, trace) over all usable vectors."""
    rows = _fit_rows(vectors, id_col, vector_col)
    sums = _sums(rows)
    out = {}
    for dim, v in _covariances(rows, sums).items():
        values, basis = Spectrum(v).leading(components)
        out[dim] = (*sums[dim], values, basis, float(np.trace(v)))
    return out


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable vector: vec_id, dim, n, deviation (decimal), whitened (an array, null where a
    component has no variance), explained (an array), identity_error (of the vectors of its length)."""
    ship(vectors.sparkSession)
    rows = _fit_rows(vectors, id_col, vector_col)
    model = fit(vectors, components, id_col, vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own, x in _integers(batch.column(1)):
                n, s, values, basis, trace = model[dim]
                d = _scaled(x, n, s)
                fine = values > dim * 1e-15 * trace
                y = (d.astype(np.float64) / n) @ basis / np.sqrt(np.where(fine, values, 1.0))
                share = np.where(fine, values / trace, 0.0) if trace > 0 else np.zeros(len(values))
                white = pa.array([[v if ok else None for v, ok in zip(r, fine)] for r in y.tolist()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own)), pa.array(np.full(len(own), dim, np.int32)), pa.array(np.full(len(own), n, np.int64)),
                     pa.array([Decimal(v) for v in squares(d)], pa.decimal128(38, 0)), white, pa.array([share.tolist()] * len(own), pa.list_(pa.float64()))],
                    ["vec_id", "dim", "n", "deviation", "whitened", "explained"])

    out = rows.mapInArrow(run, "vec_id long, dim int, n long, deviation decimal(38,0), whitened array<double>, explained array<double>")
    out = written(out, "whitened")
    errors = identity_errors(out)
    by_dim = F.create_map(*[F.lit(v) for pair in errors.items() for v in pair]) if errors else F.create_map().cast("map<int,double>")
    return out.withColumn("identity_error", F.try_element_at(by_dim, F.col("dim")))


def identity_errors(white: DataFrame) -> dict[int, float]:
    """dim -> largest absolute entry of the covariance of the whitened rows minus the identity;
    components without variance are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims):
                rows = batch.column(1).filter(pa.array(dims == dim))
                y = np.array([[np.nan if v is None else v for v in r] for r in rows.to_pylist()])
                n, mean, m2 = len(y), y.mean(0), np.zeros((y.shape[1],) * 2)
                m2 += (y - mean).T @ (y - mean)
                held[dim] = merged(held[dim], (n, mean, m2)) if dim in held else (n, mean, m2)
        for dim, (n, mean, m2) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())),
                                              pa.array([m2.ravel().tolist()], pa.list_(pa.float64()))], ["dim", "n", "mean", "m2"])

    def join(parts: pa.Table) -> pa.Table:
        total = None
        for r in parts.to_pylist():
            mean = np.array(r["mean"])
            one = (r["n"], mean, np.array(r["m2"]).reshape(len(mean), -1))
            total = one if total is None else merged(total, one)
        return pa.table({"dim": parts.column("dim").slice(0, 1), "n": pa.array([total[0]], pa.int64()), "mean": pa.array([total[1].tolist()], pa.list_(pa.float64())),
                         "m2": pa.array([total[2].ravel().tolist()], pa.list_(pa.float64()))})

    schema = "dim int, n long, mean array<double>, m2 array<double>"
    parts = white.select("dim", "whitened").mapInArrow(run, schema)
    # a small matrix per task of the pass: joined in two steps
    parts = parts.groupBy("dim", F.pmod(F.monotonically_increasing_id(), F.lit(64)).alias("part")).applyInArrow(join, schema)
    out = {}
    for r in parts.groupBy("dim").applyInArrow(join, schema).collect():      # a row per length
        m = np.array(r["m2"]).reshape(len(r["mean"]), -1) / r["n"]
        fine = np.flatnonzero(~np.isnan(np.diag(m)))
        out[r["dim"]] = float(np.abs(m[np.ix_(fine, fine)] - np.eye(len(fine))).max(initial=0.0))
    return out


def merged(a: tuple, b: tuple) -> tuple:
    """(n, mean, centred products) of two sets of rows together."""
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def digest_columns(white: DataFrame) -> DataFrame:
    """A row per vector and component; a deviation beyond a long is null."""
    pair = F.posexplode(F.arrays_zip("whitened", "explained"))
    out = white.select("vec_id", "n", F.expr("try_cast(deviation as long)").alias("deviation"), "identity_error", pair.alias("at", "pair"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("pair.whitened").alias("whitened"),
                      F.col("pair.explained").alias("explained"), "identity_error")
