"""Embedding whitening (operator 13): mixed-precision refinement of eigenvectors.

1. *Sums.*  Tasks add up integer vectors; the count and the sums per dimension
   are exact.
2. *Covariance.*  Vectors are centred on the integers nearest to their means,
   products are summed exactly, and the means' remainders (at most 1/2) are taken off
   in whole numbers, so that every entry of ``n**2 V`` is exact, in any order of
   tasks.  One row per dimension comes to the driver: its size depends on the
   dimension alone.
3. *Eigenvectors.*  ``eigh`` in single precision gives a start, and iterations of
   Ogita and Aishima made of matrix products in extended precision correct it:
   with ``R = I - X'X`` and ``S = X'VX``, ``X`` becomes ``X + XE`` where
   ``E[i,j] = (S[i,j] + l[j] R[i,j]) / (l[j] - l[i])``, or ``R[i,j] / 2`` where the two
   eigenvalues are closer than the residual can tell.  Such clusters are
   solved apart: the small matrix ``X_c'(V - mu I)X_c`` is diagonalised in double precision
   and rotates their columns, after which the iterations go on.
4. *Projection.*  Every row is projected on the components, in tasks; the
   covariance of the projections is summed once more to measure the error.

Edge cases: vectors that are null or hold null or non-finite entries are dropped, and
so are vectors of another length than most have (of equally many, the longest
stays) and those with an entry whose integer does not fit a double exactly;
repeated rows count as often as they occur; null ids are kept; directions without
variance (eigenvalue below ``dimension * 2**-50`` of the largest) are no components,
so a table of one vector, of equal vectors or of none gives no rows; equal
eigenvalues have any orthonormal vectors of their space; extra columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import ship, stage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LARGEST = float(1 << 53)
_ROUNDS = 60


# ---------------------------------------------------------------- eigenvectors

def _residuals(a: np.ndarray, x: np.ndarray):
    r = np.eye(len(a), dtype=x.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    return r, (s + s.T) / 2, values


def _clusters(values: np.ndarray, bound: float) -> list[np.ndarray]:
    """Columns whose eigenvalues follow each other within ``bound``."""
    order = np.argsort(values)[::-1]
    borders = np.flatnonzero(values[order[:-1]] - values[order[1:]] > bound) + 1
    return [c for c in np.split(order, borders) if len(c) > 1]


def _rotate(a: np.ndarray, x: np.ndarray, columns: np.ndarray) -> None:
    """Solve a cluster apart: diagonalise the matrix on its space and rotate its columns."""
    part = x[:, columns]
    part = part + part @ (np.eye(len(columns), dtype=x.dtype) - part.T @ part) / 2
    small = part.T @ (a @ part)
    mu = np.trace(small) / len(columns)
    small = ((small + small.T) / 2 - mu * np.eye(len(columns), dtype=x.dtype))
    size = np.abs(small).max()
    if size > 0:
        _, turn = np.linalg.eigh((small / size).astype(np.float64))
        part = part @ turn[:, ::-1].astype(x.dtype)
    x[:, columns] = part


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Single-precision vectors refined by matrix products in extended precision.
    """
    d = len(v)
    a = np.asarray(v, np.longdouble)
    top = np.abs(a).max() if d else 0
    if not d or top == 0:
        return np.zeros(d), np.eye(d)
    a = a / top
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start[:, ::-1].astype(np.longdouble)
    eps = np.finfo(np.longdouble).eps
    least = None
    for _ in range(_ROUNDS):
        r, s, values = _residuals(a, x)
        norm = lambda m: float(np.linalg.norm(m.astype(np.float64)))
        bound = 2 * (norm(s - np.diag(values)) + norm(a) * norm(r))
        # Below this, differences of eigenvalues are rounding.
        floor = float(4 * d * eps)
        for columns in _clusters(values, max(bound, floor)):
            _rotate(a, x, columns)
        r, s, values = _residuals(a, x)
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > max(2 * (norm(s - np.diag(values)) + norm(a) * norm(r)), floor)
        e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
        x = x + x @ e
        size = float(np.abs(e).max())
        off = float(np.abs(s - np.diag(np.diag(s))).max())
        if size <= 4 * d * eps and off <= 4 * d * eps:
            break
        if least is not None and max(size, off) >= least and size < 2.0 ** -52:
            break                                            # rounding is reached
        least = max(size, off) if least is None else min(least, max(size, off))
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.diag(x.T @ (a @ x)) * top
    order = np.argsort(values, kind="stable")[::-1]
    x, values = x[:, order], values[order]
    lead = x[np.abs(x).argmax(axis=0), np.arange(d)]
    return values.astype(np.float64), (x * np.where(lead < 0, -1, 1)).astype(np.float64)


# ---------------------------------------------------------------- tasks

def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """A batch's vectors as a matrix of whole numbers held in doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _add_sums(d: int):
    def run(batches):
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            n += len(x)
            # Sums of fewer than 2**10 whole numbers below 2**53 fit 64 bits.
            for at in range(0, len(x), 1000):
                total = [t + s for t, s in zip(total, x[at:at + 1000].astype(np.int64).sum(axis=0).tolist())]
        if n:
            yield pa.RecordBatch.from_pydict({"dim": list(range(-1, d)), "total": [str(t) for t in [n, *total]]})
    return run


def _add_products(d: int, nearest: list[int]):
    centre = np.array(nearest, np.float64)

    def run(batches):
        total = np.zeros((d, d), object)
        seen = False
        for batch in batches:
            y = _matrix(batch.column("x"), d) - centre
            if not len(y):
                continue
            seen = True
            largest = float(np.abs(y).max())
            # Products are exact in doubles while their sums stay below 2**53.
            rows = int(LARGEST // max(largest * largest, 1.0))
            if rows:
                for at in range(0, len(y), rows):
                    part = y[at:at + rows]
                    total += (part.T @ part).astype(np.int64).astype(object)
            else:
                whole = y.astype(np.int64).astype(object)
                total += whole.T @ whole
        if seen:
            yield pa.RecordBatch.from_pydict({
                "dim": [i for i in range(d) for _ in range(i, d)], "other": [j for i in range(d) for j in range(i, d)],
                "total": [str(total[i, j]) for i in range(d) for j in range(i, d)]})
    return run


def _project(d: int, n: int, sums: list[int], nearest: list[int], axes: np.ndarray):
    centre = np.array(nearest, np.float64)
    left = [s - n * m for s, m in zip(sums, nearest)]        # n * (mean - nearest)
    shift = np.array([t / n for t in left])

    def run(batches):
        for batch in batches:
            y = _matrix(batch.column("x"), d) - centre
            if not len(y):
                continue
            white = (y - shift) @ axes
            largest = n * int(np.abs(y).max()) + max(map(abs, left), default=0)
            kind = np.int64 if d * largest * largest < 1 << 62 else object
            apart = y.astype(np.int64).astype(kind) * n - np.array(left, kind)
            deviation = [str(v) for v in (apart * apart).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviation),
                 pa.ListArray.from_arrays(np.arange(0, white.size + 1, axes.shape[1], dtype=np.int32), white.ravel())],
                ["vec_id", "deviation", "white"])
    return run


def _add_white(k: int):
    def run(batches):
        n, first, second = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _matrix(batch.column("white"), k)
            n, first, second = n + len(w), first + w.sum(axis=0), second + w.T @ w
        if n:
            whole = np.vstack([first, second]).ravel()
            yield pa.RecordBatch.from_pydict({"cell": np.arange(len(whole)), "total": whole})
    return run


# ---------------------------------------------------------------- operator

def integers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x``: the usable vectors as whole numbers ``floor(64 c) + 1000000``."""
    good = F.forall("_v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST / SCALE / 2))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"))
            .where(F.col("_v").isNotNull() & good)
            .select("vec_id", F.transform("_v", lambda e: F.floor(e * SCALE) + F.lit(SHIFT)).alias("x")))


def fit(x: DataFrame, d: int) -> dict:
    """Count, sums, trace, eigenvalues and components of the vectors ``x``, all of length ``d``."""
    sums = (x.select("x").mapInArrow(_add_sums(d), "dim long, total string")
            .groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    total = {r["dim"]: int(r["total"]) for r in sums}
    n, sums = total[-1], [total[i] for i in range(d)]
    nearest = [(2 * s + n) // (2 * n) for s in sums]
    left = [s - n * m for s, m in zip(sums, nearest)]
    products = (x.select("x").mapInArrow(_add_products(d, nearest), "dim long, other long, total string")
                .groupBy("dim", "other").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
                .groupBy("dim").agg(F.map_from_entries(F.collect_list(F.struct("other", F.col("total").cast("string")))).alias("row")))
    v, trace = np.zeros((d, d), np.longdouble), Fraction(0)
    for r in products.collect():                             # d rows
        i = r["dim"]
        for j, cell in r["row"].items():
            whole = n * int(cell) - left[i] * left[j]        # n**2 times the covariance
            high = float(whole)
            v[i, j] = v[j, i] = (np.longdouble(high) + np.longdouble(float(whole - int(high)))) / np.longdouble(n) / np.longdouble(n)
            if i == j:
                trace += Fraction(whole, n * n)
    values, vectors = eigenvectors(v)
    return {"d": d, "n": n, "sums": sums, "nearest": nearest, "trace": float(trace), "values": values, "vectors": vectors}


def whitened(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable vector.

    ``deviation`` is exact, a ``decimal(38,0)``.
    """
    spark = vectors.sparkSession
    ship(spark)
    schema = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    x = integers(vectors, vec_id, vector)
    lengths = x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.agg(F.max(F.struct("n", "d")).alias("top")).first()["top"]
    if usual is None or usual["d"] == 0:
        return spark.createDataFrame([], schema)
    x = x.where(F.size("x") == usual["d"])
    model = fit(x, usual["d"])
    values = model["values"]
    keep = [i for i in range(min(components, model["d"])) if values[i] > model["d"] * 2.0 ** -50 * max(values[0], 0)]
    if not keep:
        return spark.createDataFrame([], schema)
    k = len(keep)
    axes = model["vectors"][:, keep] / np.sqrt(values[keep])
    rows = stage(x.mapInArrow(_project(model["d"], model["n"], model["sums"], model["nearest"], axes),
                              "vec_id long, deviation string, white array<double>"), "whitened")
    cells = (rows.select("white").mapInArrow(_add_white(k), "cell long, total double")
             .groupBy("cell").agg(F.sum("total").alias("total")).collect())         # k * (k + 1) rows
    total = np.zeros(k * (k + 1))
    for r in cells:
        total[r["cell"]] = r["total"]
    mean = total[:k] / model["n"]
    error = np.abs(total[k:].reshape(k, k) / model["n"] - np.outer(mean, mean) - np.eye(k)).max()
    share = F.array(*[F.lit(float(values[i] / model["trace"])) for i in keep])
    return (rows.select("vec_id", F.col("deviation").cast("decimal(38,0)").alias("deviation"), F.posexplode("white").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model["n"]).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error")))
