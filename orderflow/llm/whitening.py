"""Embedding whitening by pivoted Cholesky of the centred scatter and one-sided Jacobi on its triangular factor.

Entries become whole numbers x = floor(64 * c) + 1000000. One pass sums them exactly; a second takes x less its mean,
then sums products (whole part of the mean first, its fraction after, so that no digits cancel). The d x d scatter is
factored on the driver as P L L' P', the largest remaining diagonal entry as pivot, as far as its rank goes. Rotations of pairs of
columns of L, half of all columns at once, make them orthogonal: their squared norms are the eigenvalues of the scatter,
the columns divided by their norms its components, without forming L' L. Rows are then projected in the tasks.

The driver holds the means, the scatter and the components: d * d numbers, whatever the number of rows.

Defined cases: vectors that are null or empty, hold null or non-finite entries, entries whose x is no long, or that have another
length than most (of equally many, than the longest) take no part and give no row; repeated ids are rows of their own;
components of no variance (to rounding) are left out, so equal vectors or a single row have none and whiten to an empty
array; of equal eigenvalues any orthogonal components serve; ``deviation`` is null where it exceeds a long; an empty table
gives no rows; input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Of a pivot to the first one: below, what is left is rounding.
RANK = 1e-13
BLOCK_ROWS = 2048


@dataclass
class Model:
    n: int
    whole: np.ndarray  # whole part of the means, long
    rest: np.ndarray  # sums less n times the whole part, long, 0 to n - 1
    sums: list[int]
    components: np.ndarray  # d x k, unit columns by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float


def fit_rows(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows that take part, with their whole numbers in ``_x``."""
    values = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double") * SCALE)
    # NaN and infinities are above the bound
    good = F.forall(values, lambda c: F.coalesce(F.abs(c) < F.lit(2.0**62), F.lit(False)))
    rows = df.where(F.col(f"`{vector}`").isNotNull() & (F.size(f"`{vector}`") > 0)).where(good)
    lengths = rows.groupBy(F.size(f"`{vector}`").alias("d")).count()
    most = lengths.agg(F.max_by("d", F.struct("count", "d"))).first()[0]
    rows = rows.where(F.size(f"`{vector}`") == (most or 0))
    return rows.withColumn("_x", F.transform(values, lambda c: F.floor(c) + SHIFT))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("_x")
    return np.asarray(lists.flatten()).reshape(batch.num_rows, -1)


def _sums(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum over all rows of ``of(block)``, a matrix; one set of partial sums per task, added by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = of(_matrix(batch.slice(start, BLOCK_ROWS)))
                total = part if total is None else total + part
        for i, row in enumerate([] if total is None else total):
            yield pa.RecordBatch.from_pydict({"i": np.full(len(row), i, np.int32), "j": np.arange(len(row), dtype=np.int32), "v": row})

    parts = rows.select("_x").mapInArrow(run, "i int, j int, v double")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().to_pydict()
    if not found["i"]:
        return None
    out = np.zeros((max(found["i"]) + 1, max(found["j"]) + 1))
    out[found["i"], found["j"]] = found["v"]
    return out


def _exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the sum of every dimension, as whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0  # x = high * 2**20 + low, so that neither sum leaves a long
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                n, high, low = n + len(x), high + (x >> 20).sum(0), low + (x & 0xFFFFF).sum(0)
        if n:
            d = len(high)
            yield pa.RecordBatch.from_pydict({"j": np.arange(d, dtype=np.int32), "n": np.full(d, n), "high": high, "low": low})

    parts = rows.select("_x").mapInArrow(run, "j int, n bigint, high bigint, low bigint").groupBy("j")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    found = sorted(parts.agg(*exact).collect(), key=lambda r: r["j"])
    return (int(found[0]["n"]) if found else 0), [(int(r["high"]) << 20) + int(r["low"]) for r in found]


def cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with scatter[order][:, order] = L L', L lower trapezoidal, one column per pivot above rounding."""
    a = scatter.copy()
    d, order, low = len(a), np.arange(len(a)), np.zeros_like(a)
    first = a.diagonal().max(initial=0.0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= RANK * first or a[p, p] <= 0:
            return low[:, :k], order
        for m in (a, a.T, low):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1 :, k] = a[k + 1 :, k] / low[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
    return low, order


def _turns(k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs of columns that meet every pair once, as in a tournament; k even."""
    seats = np.arange(k)
    for _ in range(k - 1):
        yield seats[: k // 2], seats[: k // 2 - 1 : -1]
        seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])


def orthogonal(low: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns rotated in pairs until every two are orthogonal to rounding."""
    d, k = low.shape
    w = np.zeros((d, k + k % 2))
    w[:, :k] = low
    for _ in range(sweeps if k > 1 else 0):
        worst = 0.0
        for i, j in _turns(w.shape[1]):
            a, b = w[:, i], w[:, j]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            scale = np.sqrt(aa * bb)
            turn = np.abs(ab) > 1e-15 * scale
            worst = max(worst, float((np.abs(ab[turn]) / scale[turn]).max(initial=0.0)))
            zeta = np.divide(bb - aa, 2 * ab, out=np.zeros_like(ab), where=turn)
            t = np.where(turn, np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.hypot(1, zeta)), 0.0)
            c = 1 / np.hypot(1, t)
            w[:, i], w[:, j] = c * a - c * t * b, c * t * a + c * b
        if worst < 1e-14:
            break
    return w


def components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a scatter matrix, falling, none of zero."""
    low, order = cholesky(scatter)
    w = orthogonal(low)
    norms = np.sqrt((w * w).sum(0))
    best = np.argsort(-norms, kind="stable")
    best = best[norms[best] > np.sqrt(RANK) * norms.max(initial=0.0)]
    vectors = np.zeros((len(scatter), len(best)))
    vectors[order] = w[:, best] / norms[best]
    return norms[best] ** 2, vectors


def fit(rows: DataFrame) -> Model:
    """``rows``: from ``fit_rows``."""
    n, sums = _exact_sums(rows)
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)

    def products(x: np.ndarray) -> np.ndarray:
        d = (x - whole) - rest / n
        return d.T @ d

    scatter = _sums(rows, products) if n else None
    scatter = np.zeros((0, 0)) if scatter is None else (scatter + scatter.T) / 2
    values, vectors = components(scatter)
    return Model(n, whole, rest, sums, vectors, values / max(n, 1), float(np.trace(scatter)) / max(n, 1))


def _whiten(model: Model, count: int) -> Callable[[np.ndarray], np.ndarray]:
    n, whole, rest = model.n, model.whole, model.rest
    turned = model.components[:, :count] / np.sqrt(model.eigenvalues[:count])
    return lambda x: ((x - whole) - rest / n) @ turned


def _deviations(away: np.ndarray, n: int, rest: np.ndarray) -> pa.Array:
    """Sums of squares of n * away - rest, exact; null where one exceeds a long."""
    most = np.abs(away).max(1, initial=0).astype(float) * n + n
    fits = most * most * max(1, away.shape[1]) < 2.0**62
    y = away[fits] * n - rest
    out = np.zeros(len(away), object)
    out[fits] = (y * y).sum(1)
    for i in np.flatnonzero(~fits):  # beyond 64 bits on the way
        total = sum((int(a) * n - int(r)) ** 2 for a, r in zip(away[i], rest))
        out[i] = total if total < 1 << 63 else None
    return pa.array(out, pa.int64())


def transform(rows: DataFrame, model: Model, count: int = COMPONENTS) -> DataFrame:
    """All rows of ``fit_rows`` with ``deviation`` and ``whitened``, the first ``count`` components."""
    of, n, whole, rest = _whiten(model, count), model.n, model.whole, model.rest

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            rows = len(part)
            x = np.asarray(part.flatten()).reshape(rows, -1) if rows else np.zeros((0, len(whole)), np.int64)
            squares = _deviations(x - whole, n, rest)
            w = np.concatenate([of(x[s : s + BLOCK_ROWS]) for s in range(0, rows, BLOCK_ROWS)]) if rows else of(x)
            k = w.shape[1]
            lists = pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * k, w.ravel())
            yield pa.StructArray.from_arrays([squares, lists], ["deviation", "whitened"])

    udf = F.arrow_udf(run, "deviation bigint, whitened array<double>").asNondeterministic()
    rows = rows.withColumn("_w", udf(F.col("_x")))
    return rows.withColumns({"deviation": F.col("_w.deviation"), "whitened": F.col("_w.whitened")}).drop("_x", "_w")


def identity_error(rows: DataFrame, model: Model, count: int = COMPONENTS) -> float:
    """The largest entry of the whitened rows' covariance less the identity; 0 without components."""
    of = _whiten(model, count)
    total = _sums(rows, lambda x: of(x).sum(0)[None, :])
    if total is None or not total.size:
        return 0.0
    mean = total[0] / model.n

    def products(x: np.ndarray) -> np.ndarray:
        w = of(x) - mean
        return w.T @ w

    return float(np.abs(_sums(rows, products) / model.n - np.eye(len(mean))).max())


def whiten(df: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> tuple[DataFrame, Model, float]:
    """(rows that take part with deviation and whitened, the model, the identity error)."""
    df = df.drop(*({"deviation", "whitened", "_x", "_w"} - {vector}))
    rows = fit_rows(df, vector)
    model = fit(rows)
    return transform(rows, model, count), model, identity_error(rows, model, count)
