"""Whitening of embeddings by spectrum slicing.

Sums and centred products of the distinct quantised vectors are added up over
tasks; only the covariance, one number per pair of dimensions, comes to the
driver. Its leading eigenvalues are found one by one: the pivots of an LDL'
factorisation of the shifted covariance tell how many eigenvalues lie above the
shift, so bisection isolates the k-th one in an interval of its own. Inverse
iteration and then the Rayleigh quotient as shift converge cubically to it, and
counts on both sides certify that it is the k-th. Rows are projected in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.topk import usable
from riskloom.session import scratch_path

SCALE = 256
COMPONENTS = 4
SAFE = 2**62  # integers whose size is bounded by it are added in 64 bits
PIVOT = (1 + sqrt(17)) / 8  # below this share of the largest entry a diagonal pivot gives way to a pair
STEPS = 60  # of an eigenvector's iteration between two bisections


def inertia(matrix: np.ndarray, shift: float) -> tuple[int, int]:
    """How many eigenvalues of a symmetric matrix lie below and above the shift, from LDL' pivots of one and two rows."""
    a = np.array(matrix, np.float64)
    a[np.diag_indices_from(a)] -= shift
    below = above = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        rest = np.abs(a)
        np.fill_diagonal(rest, -1.0)
        i, (r, s) = int(diagonal.argmax()), np.unravel_index(int(rest.argmax()), rest.shape)
        largest = max(float(rest[r, s]), 0.0)
        if diagonal[i] == 0 and largest == 0:
            break
        if diagonal[i] >= PIVOT * largest:
            taken, pivots = [i], [a[i, i]]
        else:
            taken, pivots = sorted([int(r), int(s)]), [-1.0, 1.0]  # such a pair has one eigenvalue of either sign
        below += sum(p < 0 for p in pivots)
        above += sum(p > 0 for p in pivots)
        stay = np.delete(np.arange(len(a)), taken)
        side = a[np.ix_(stay, taken)]
        a = a[np.ix_(stay, stay)] - side @ np.linalg.solve(a[np.ix_(taken, taken)], side.T)
        a = (a + a.T) / 2
    return below, above


class Slices:
    """Leading eigenpairs of a positive semidefinite matrix."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = (matrix + matrix.T) / 2
        self.norm = float(np.abs(self.matrix).sum(axis=1).max(initial=0))  # bounds all eigenvalues
        self.least = 4 * len(matrix) * np.finfo(float).eps * self.norm  # what rounding can hide
        self.counted = {-self.least: len(matrix), self.norm + self.least: 0}  # eigenvalues above a shift

    def above(self, shift: float) -> int:
        if shift not in self.counted:
            self.counted[shift] = inertia(self.matrix, shift)[1]
        return self.counted[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """The narrowest ends counted so far around the k-th largest eigenvalue."""
        return max(s for s, n in self.counted.items() if n >= k), min(s for s, n in self.counted.items() if n < k)

    def isolated(self, k: int) -> tuple[float, float, bool]:
        """An interval of the k-th eigenvalue, bisected until it is alone or too narrow to tell."""
        while True:
            low, high = self.interval(k)
            alone = self.counted[low] == k and self.counted[high] == k - 1
            if alone or high - low <= self.least:
                return low, high, alone
            self.above((low + high) / 2)

    def pair(self, k: int, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
        """The k-th eigenvalue and a unit vector, orthogonal to those found before."""
        start = np.random.default_rng(k).normal(size=len(self.matrix))
        while True:
            low, high, alone = self.isolated(k)
            value, vector = self._iterated(low, high, self._apart(start, found), found)
            if value is not None:
                if alone:  # counts on both sides: exactly the k-th lies here
                    margin = 4 * self.least
                    assert self.above(value - margin) >= k > self.above(value + margin)
                return value, vector
            self.above((low + high) / 2)

    @staticmethod
    def _apart(vector: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        for _ in range(2):
            for other in found:
                vector = vector - (other @ vector) * other
        return vector / np.linalg.norm(vector)

    def _iterated(self, low: float, high: float, vector: np.ndarray, found: list[np.ndarray]):
        """Inverse iteration at the interval's middle, then at the Rayleigh quotient once that lies inside."""
        unit, shift = np.eye(len(vector)), (low + high) / 2
        best = None
        for step in range(STEPS):
            try:
                solved = np.linalg.solve(self.matrix - shift * unit, vector)
            except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
                solved = np.linalg.solve(self.matrix - (shift + self.least) * unit, vector)
            vector = self._apart(solved / np.abs(solved).max(), found)
            image = self.matrix @ vector
            value = float(vector @ image)
            residual = float(np.linalg.norm(image - value * vector))
            inside = low - self.least <= value <= high + self.least
            if inside and residual <= self.least:
                if best is not None and residual >= best[2] / 2:
                    return best[:2]
                best = (value, vector, residual)
            # early steps keep the middle, whose nearest eigenvalue is the wanted one
            if inside and step >= 2 and residual < (high - low) / 4 and high - low > self.least:
                shift = value
        return best[:2] if best else (None, None)


def leading(matrix: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as rows; only those that are not zero to rounding."""
    slices, values, vectors = Slices(matrix), [], []
    for k in range(1, min(components, len(matrix)) + 1):
        if slices.above(slices.least) < k:
            break
        value, vector = slices.pair(k, vectors)
        values.append(value)
        vectors.append(vector * np.sign(vector[np.abs(vector).argmax()]))
    return np.array(values), np.array(vectors).reshape(len(values), len(matrix))


@dataclass
class Fit:
    """What a length's distinct vectors give: their number, sums, components and error."""

    n: int
    sums: list[int]
    values: np.ndarray = field(default_factory=lambda: np.empty(0))
    vectors: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    trace: float = 0.0
    error: float = 0.0

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        """n*x - S: 64-bit integers where they fit, else Python's."""
        most = max(map(abs, self.sums), default=0)
        if int(np.abs(rows.astype(np.float64)).max(initial=0)) * self.n + most < SAFE:
            return rows * np.int64(self.n) - np.array(self.sums, np.int64)
        return rows.astype(object) * self.n - np.array(self.sums, object)

    def deviations(self, scaled: np.ndarray) -> pa.Array:
        if scaled.dtype != object and int(np.abs(scaled).max(initial=0)) ** 2 * scaled.shape[1] < SAFE:
            return pa.array((scaled * scaled).sum(axis=1), pa.int64())
        exact = [sum(int(v) ** 2 for v in row) for row in scaled]
        return pa.array([v if v < 2**63 else None for v in exact], pa.int64())

    def centred(self, scaled: np.ndarray) -> np.ndarray:
        return (scaled / self.n).astype(np.float64)

    def whitened(self, scaled: np.ndarray) -> np.ndarray:
        return self.centred(scaled) @ self.vectors.T / np.sqrt(self.values)


def _lengths(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors as a matrix) for each length of vector in a batch."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        if size:
            rows = np.flatnonzero(sizes == size)
            yield rows, flat[starts[rows][:, None] + np.arange(size)]


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"whitening-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _totals(vectors: DataFrame) -> dict[int, Fit]:
    """Number and exact sums of the vectors of every length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for rows, x in _lengths(batch.column("x")):
                n, sums = held.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
                safe = float(np.abs(x.astype(np.float64)).max(initial=0)) * len(x) < SAFE
                part = x.sum(axis=0).astype(object) if safe else x.astype(object).sum(axis=0)
                held[x.shape[1]] = [n + len(rows), sums + part]
        for size, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                 pa.array([str(int(s)) for s in sums])],
                ["size", "i", "n", "total"],
            )

    parts = vectors.select("x").mapInArrow(run, "size int, i int, n bigint, total string")
    summed = parts.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    fits: dict[int, Fit] = {}
    for r in summed.orderBy("size", "i").collect():  # one row per dimension
        fits.setdefault(r["size"], Fit(r["n"], [])).sums.append(int(r["total"]))
    return fits


def _products(vectors: DataFrame, fits: dict[int, Fit], of) -> dict[int, np.ndarray]:
    """For every length the sum over its vectors of the products of the columns of ``of(fit, n*x - S)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _lengths(batch.column("x")):
                fit = fits[x.shape[1]]
                y = of(fit, fit.scaled(x))
                held[x.shape[1]] = held.get(x.shape[1], 0) + y.T @ y
        for size, products in held.items():
            for i, row in enumerate(products):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * len(row), pa.int32()), pa.array([i] * len(row), pa.int32()),
                     pa.array(range(len(row)), pa.int32()), pa.array(row, pa.float64())],
                    ["size", "i", "j", "total"],
                )

    parts = vectors.select("x").mapInArrow(run, "size int, i int, j int, total double")
    out: dict[int, np.ndarray] = {}
    for r in parts.groupBy("size", "i", "j").agg(F.sum("total").alias("total")).toLocalIterator():  # dimensions squared
        if r["size"] not in out:
            width = of(fits[r["size"]], np.zeros((1, r["size"]), np.int64)).shape[1]
            out[r["size"]] = np.zeros((width, width))
        out[r["size"]][r["i"], r["j"]] = r["total"]
    return out


def _with_one(fit: Fit, scaled: np.ndarray) -> np.ndarray:
    """The whitened columns and one of ones, whose products are the columns' sums."""
    return np.hstack([fit.whitened(scaled), np.ones((len(scaled), 1))])


def fitted(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    fits = _totals(distinct)
    for size, products in _products(distinct, fits, Fit.centred).items():
        fit = fits[size]
        fit.values, fit.vectors = leading(products / fit.n, components)
        fit.trace = float(np.trace(products)) / fit.n
    for size, products in _products(distinct, fits, _with_one).items():
        fit, k = fits[size], len(fits[size].values)
        if k:
            means = products[k, :k] / fit.n
            fit.error = float(np.abs(products[:k, :k] / fit.n - np.outer(means, means) - np.eye(k)).max())
    return fits


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries are quantised to floor(scale * c). Mean and covariance are those of
    the distinct quantised vectors, ``n`` of them; repeated rows are projected
    each. Vectors that are null, or hold a null or non-finite entry, are left
    out; a null key is kept. Vectors of different lengths are fitted apart.
    Components whose eigenvalue is zero to rounding are left out, so one
    vector alone, equal vectors and empty vectors have no rows, like an empty
    table. A deviation beyond 64 bits is null; quantised entries beyond 64 bits
    are cut to the range's ends. Other columns are not read.
    """
    rows = vectors.where(usable(F.col(f"`{vector}`"))).select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.transform(F.col(f"`{vector}`"), lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("x"),
    )
    distinct = _written(rows.select("x").distinct(), "distinct")
    fits = fitted(distinct, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _lengths(batch.column("x")):
                fit = fits[x.shape[1]]
                k, n = len(fit.values), len(at)
                if not k:
                    continue
                scaled = fit.scaled(x)
                each = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(at)).take(each), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                     pa.array(np.full(n * k, fit.n), pa.int64()), fit.deviations(scaled).take(each),
                     pa.array(fit.whitened(scaled).ravel()), pa.array(np.tile(fit.values / fit.trace, n)),
                     pa.array(np.full(n * k, fit.error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(
        run,
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    )
