"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries are taken as integers (``floor(scale * c) + shift``), so that counts, sums and deviations are exact. Tasks add up
sums and scatters of their rows and Spark adds those; what reaches the driver is of the size of the model, d x d numbers
for d dimensions, however many rows there are. The Jacobi rotations turn the columns of the factor until they are
orthogonal: their squared norms are the eigenvalues, with small ones as precise as large ones, and the normalised
columns are the components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name

SCALE, SHIFT = 1024, 100_000
#: Rows of which a task holds the numbers at once.
ROWS_AT_ONCE = 4_096
#: Beyond this, integer arithmetic goes on in Python's integers.
_SAFE = float(1 << 62)
_LONG = (1 << 63) - 1


@dataclass
class Whitening:
    """What is learned: rows and sums of the fit list, components (one a row) and eigenvalues, largest first."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.eigenvalues]


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is there and holds finite numbers only, at least one."""
    value = F.col(column).cast("array<double>")
    fine = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(value.isNotNull() & (F.size(value) > 0) & fine)


def integers(values: np.ndarray, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    """floor(scale * c) + shift as 64-bit integers; what does not fit stops at the ends of 62 bits."""
    with np.errstate(over="ignore"):  # beyond the doubles it is infinite, and stops at the ends, too
        return np.clip(np.floor(scale * values), -_SAFE, _SAFE).astype(np.int64) + shift


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: 64-bit integers where they are wide enough, else Python's."""
    largest = max([abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))])
    if max(largest * n, *(abs(s) for s in sums)) < _SAFE:
        return n * x - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _matrices(batches, dimensions: int | None = None):
    """(batch slice, doubles as a matrix): rows of a few thousand, all of the same length."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            lists = part.column(0)
            sizes = np.diff(lists.offsets.to_numpy())
            for size in np.unique(sizes) if dimensions is None else (dimensions,):
                rows = np.flatnonzero(sizes == size)
                if len(rows):
                    chosen = part if len(rows) == part.num_rows else part.take(pa.array(rows))
                    yield chosen, chosen.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), size)


def _lengths_and_sums(batches):
    """A row for each length and place: number of rows and sum of the integers, of one task."""
    found: dict[int, list] = {}
    for _, values in _matrices(batches):
        x = integers(values)
        n, high, low = found.setdefault(x.shape[1], [0, 0, 0])
        found[x.shape[1]] = [n + len(x), high + (x >> 32).sum(axis=0).astype(object), low + (x & 0xFFFFFFFF).sum(axis=0).astype(object)]
    for size, (n, high, low) in found.items():
        total = [str(int(h) * (1 << 32) + int(o)) for h, o in zip(high, low)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array(total)],
            ["d", "place", "n", "total"],
        )


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order): matrix[order][:, order] = factor @ factor.T, with as many columns as the matrix has rank."""
    left = matrix.astype(float).copy()
    size = len(left)
    order, factor = np.arange(size), np.zeros((size, size))
    least = size * np.finfo(float).eps * max(float(left.diagonal().max(initial=0.0)), 0.0)
    for k in range(size):
        pivot = k + int(np.argmax(left.diagonal()[k:]))
        if left[pivot, pivot] <= least:
            return factor[:, :k], order
        for rows in (left, left.T, factor, order):
            rows[[k, pivot]] = rows[[pivot, k]]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1 :, k] = left[k + 1 :, k] / factor[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def _rounds(size: int):
    """All pairs of columns in rounds of disjoint pairs, as players of a tournament meet."""
    players = list(range(size + size % 2))
    for _ in range(len(players) - 1):
        pairs = [(players[i], players[-1 - i]) for i in range(len(players) // 2)]
        pairs = np.array([sorted(p) for p in pairs if max(p) < size], dtype=int).reshape(-1, 2)
        yield pairs[:, 0], pairs[:, 1]
        players = [players[0], players[-1], *players[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated until every two are orthogonal to rounding."""
    columns = factor.T.copy()
    limit = 4 * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(len(columns)):
            one, two = columns[p], columns[q]
            a, b, c = (one * one).sum(1), (two * two).sum(1), (one * two).sum(1)
            at = np.abs(c) > limit * np.sqrt(a * b)
            if not at.any():
                continue
            turned = True
            p, q, one, two = p[at], q[at], one[at], two[at]
            zeta = (b[at] - a[at]) / (2 * c[at])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            sin = (cos * t)[:, None]
            cos = cos[:, None]
            columns[p], columns[q] = cos * one - sin * two, sin * one + cos * two
        if not turned:
            break
    return columns.T


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as rows) of a scatter matrix, largest first, as many as its rank.

    Either sign is right; the entry of largest size is made positive.
    """
    factor, order = pivoted_cholesky(scatter)
    turned = np.zeros_like(factor)
    turned[order] = one_sided_jacobi(factor)
    values = (turned * turned).sum(axis=0)
    rank = np.argsort(-values, kind="stable")
    values, vectors = values[rank], (turned[:, rank] / np.sqrt(values[rank])).T
    if len(vectors):
        vectors *= np.sign(vectors[np.arange(len(vectors)), np.argmax(np.abs(vectors), axis=1)])[:, None]
    return values, vectors


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' matrices (place, value), as a matrix of ``size`` columns."""
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(max((r["place"] for r in rows), default=-1) + 1)
    for r in rows:
        total[r["place"]] = r["value"]
    return total.reshape(-1, size)


def fit(vectors: DataFrame, column: str = "embedding", components: int = 8) -> Whitening:
    """Learn from all usable vectors.

    Vectors that are null or empty or hold a null or a number that is not finite are left out, and so are those whose
    length is not the most frequent one (the shorter of equally frequent lengths). Repeated rows count as often as they
    stand there. Components with an eigenvalue of zero, as one row or equal rows have, are not returned; a table without
    usable vectors has none.
    """
    value = F.col(column).cast("array<double>").alias("v")
    rows = usable(vectors, column).select(value)
    sums = rows.mapInArrow(_lengths_and_sums, "d int, place int, n long, total string")
    sums = sums.groupBy("d", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    # the most frequent length alone comes to the driver
    lengths = sums.filter("place = 0").orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    size, n = lengths[0]["d"], lengths[0]["n"]
    totals = [int(r["total"]) for r in sums.filter(F.col("d") == size).orderBy("place").collect()]

    def scatter(batches):
        """Products of the centred integers: the mean goes before anything is multiplied."""
        total = np.zeros((size, size))
        for _, values in _matrices(batches, size):
            centred = (deviations(integers(values), n, totals) / n).astype(float)
            total += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(range(size * size), pa.int32()), pa.array(total.ravel())], ["place", "value"])

    found = _summed(rows.mapInArrow(scatter, "place int, value double"), size)
    values, vectors_ = principal(found)
    keep = min(components, len(values))
    return Whitening(n, totals, vectors_[:keep], values[:keep] / n, float(np.trace(found)) / n)


def transform(
    vectors: DataFrame, model: Whitening, column: str = "embedding", kept: list[str] | None = None,
    names: tuple[str, str] = ("deviation", "whitened"),
) -> DataFrame:
    """The columns ``kept`` (all by default) of the vectors that ``fit`` takes, with two more.

    ``deviation`` is the exact sum over the dimensions of (n * x - sums)^2, null where 64 bits do not hold it;
    ``whitened`` an array with a number for each component. A kept column of one of the two names gives way.
    """
    new = {c.lower() for c in names}
    kept = [c for c in (vectors.columns if kept is None else kept) if c.lower() not in new]
    held = [f"c{i}" for i in range(len(kept))]
    size = model.dimensions

    def compute(batches):
        turn = model.components.T / np.sqrt(model.eigenvalues)
        for part, values in _matrices(batches, size):
            off = deviations(integers(values), model.n, model.sums)
            largest = max(abs(int(off.max(initial=0))), abs(int(off.min(initial=0))))
            whole = off if largest * largest * size < _SAFE else off.astype(object)
            square = [s if s <= _LONG else None for s in (whole * whole).sum(axis=1).tolist()]
            white = (off / model.n).astype(float) @ turn
            lists = pa.ListArray.from_arrays(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1], pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([*(part.column(i + 1) for i in range(len(kept))), pa.array(square, pa.int64()), lists], [*held, "s", "w"])

    fields = [T.StructField(h, vectors.schema[c].dataType) for h, c in zip(held, kept)]
    schema = T.StructType([*fields, T.StructField("s", T.LongType()), T.StructField("w", T.ArrayType(T.DoubleType()))])
    rows = usable(vectors, column)
    rows = rows.select(F.col(column).cast("array<double>").alias("v"), *(F.col(f"`{c}`").alias(h) for c, h in zip(kept, held)))
    rows = rows.filter(F.size("v") == size) if model.n else rows.limit(0)
    named = [F.col(h).alias(c) for c, h in zip(kept, held)]
    return rows.mapInArrow(compute, schema).select(*named, F.col("s").alias(names[0]), F.col("w").alias(names[1]))


def identity_error(transformed: DataFrame, model: Whitening, column: str = "whitened") -> float:
    """The largest entry, in size, of the covariance of the whitened rows minus the identity; 0 without components."""
    size = len(model.components)
    if not size:
        return 0.0

    def products(batches):
        total, first = np.zeros((size, size)), np.zeros((1, size))
        for _, white in _matrices(batches, size):
            total += white.T @ white
            first += white.sum(axis=0)
        both = np.concatenate([total, first]).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(both)), pa.int32()), pa.array(both)], ["place", "value"])

    both = _summed(transformed.select(F.col(column).alias("v")).mapInArrow(products, "place int, value double"), size) / model.n
    mean = both[size:]  # zero but for rounding: what is whitened was centred before
    return float(np.abs(both[:size] - mean.T @ mean - np.eye(size)).max())


def report(transformed: DataFrame, model: Whitening, key: str = "vec_id", whitened: str = "whitened") -> DataFrame:
    """One row for each whitened row and component: key, component (from 1), n, deviation, whitened, explained,
    identity_error."""
    place = free_name(transformed, "place")
    rows = transformed.select(key, "deviation", F.posexplode(whitened).alias(place, "value"))
    shares = F.array(*map(F.lit, model.explained())) if len(model.components) else F.array().cast("array<double>")
    return rows.select(
        key,
        (F.col(place) + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(shares, F.col(place)).alias("explained"),
        F.lit(identity_error(transformed, model, whitened)).alias("identity_error"),
    )
