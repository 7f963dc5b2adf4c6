"""Embedding whitening: principal components by spectral divide and conquer with QDWH polar factors.

1. Vectors become whole numbers (``SCALE`` steps a unit, rounded down); the distinct ones are the fit list, a stored table.
2. Sums, least and greatest entries a dimension, then the products of entries, less a whole number near each dimension's
   mean, are added up task by task. They are whole numbers, so the covariance is exact until it is divided.
3. The covariance (a square of the dimension, whatever the number of vectors) is split on the driver: the orthogonal polar
   factor of the covariance less a shift, by QR- and Cholesky-based dynamically weighted Halley steps, gives the projector
   onto the eigenvectors above the shift; it is split again until the parts with the first components hold one each.
4. Mean, components and their scale go to the tasks, which whiten all rows.

Defined results: rows with a null vector, or null or non-finite entries, take no part; nor do empty vectors and those of
another length than most distinct vectors have (of equally frequent lengths the longest); equal vectors count once in the
fit and are whitened each; rows with equal or null ids are kept; a dimension without variance, or a lone vector, has no
component of its own, so that there may be fewer components than asked for, or none; equal eigenvalues have components of
either order; extra columns are kept by :func:`transform` and ignored by :func:`digest`; an empty table gives no rows. An
entry beyond ``MOST`` steps is an error, and so is a vector of more than ``DIMENSIONS`` entries. ``deviation`` is null where
it is too large for a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.llm import common

COMPONENTS, SCALE, DIMENSIONS, MOST = 4, 256, 4096, 2**40
EPS = float(np.finfo(np.float64).eps)
#: Parts that partial sums of products are added up in first, and rows that a task multiplies at once.
PARTS, ROWS = 64, 4096
LONG, EXACT = 2**63, 2**53


def weights(low: float) -> tuple[float, float, float]:
    """The weights a, b, c of a Halley step, x (a + b x^2) / (1 + c x^2), for singular values in [low, 1]."""
    d = np.cbrt(4 * (1 - low * low) / low**4)
    a = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d))) / 2
    b = (a - 1) ** 2 / 4
    return float(a), float(b), float(a + b - 1)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: for each eigenvector its eigenvalue's sign. An eigenvalue within
    rounding of 0 keeps a factor of its own between -1 and 1."""
    m = len(a)
    eye = np.eye(m)
    x, low = a / min(np.linalg.norm(a), np.abs(a).sum(axis=1).max()), EPS
    for _ in range(30):
        p, q, c = weights(low)
        if c > 100:
            w = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
            new = (q / c) * x + (p - q / c) / np.sqrt(c) * (w[:m] @ w[m:].T)
        else:
            z = np.linalg.cholesky(eye + c * (x.T @ x))
            new = (q / c) * x + (p - q / c) * np.linalg.solve(z.T, np.linalg.solve(z, x.T)).T
        new = (new + new.T) / 2
        step, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (p + q * low * low) / (1 + c * low * low))
        if 1 - low < 10 * EPS and step < EPS ** (1 / 3):
            break
    return x


def shifts(a: np.ndarray) -> Iterator[float]:
    """Values inside the range of the eigenvalues: where the diagonal's mean parts them badly, others follow."""
    diagonal = np.sort(np.diag(a))
    mean, spread = float(diagonal.mean()), float(np.linalg.norm(a - diagonal.mean() * np.eye(len(a)))) / len(a)
    yield mean
    yield float(np.median(diagonal))
    for k in range(1, 8):
        yield mean + spread * k / 8
        yield mean - spread * k / 8


def halves(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Bases of the invariant subspaces above and below a shift, of the shift that leaves the least between them."""
    m, best = len(a), None
    for shift in shifts(a):
        u = polar(a - shift * np.eye(m))
        k = round((np.trace(u) + m) / 2)
        if not 0 < k < m:
            continue
        projector = (u + np.eye(m)) / 2
        x = np.random.default_rng(m).standard_normal((m, k))
        for _ in range(2):
            x = np.linalg.qr(projector @ x)[0]
        basis = np.linalg.qr(projector @ x, mode="complete")[0]
        between = float(np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]))
        if best is None or between < best[0]:
            best = between, basis[:, :k], basis[:, k:]
        if between <= 8 * EPS * scale:
            break
    if best is None:
        raise ArithmeticError("no shift parts the eigenvalues")
    return best[1], best[2]


def principal(a: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns; only those that
    rounding tells from 0. Parts below the ones asked for aren't split."""
    scale = float(np.linalg.norm(a))
    found: list[np.ndarray] = []
    parts = [np.eye(len(a))] if scale else []
    while parts and len(found) < most:
        v = parts.pop()
        mine = v.T @ a @ v
        mine = (mine + mine.T) / 2
        mean = float(np.diag(mine).mean())
        if len(mine) == 1 or np.linalg.norm(mine - mean * np.eye(len(mine))) <= 2 * EPS * scale:
            found.extend(v.T)
        else:
            above, below = halves(mine, scale)
            parts += [v @ below, v @ above]
    if not found:
        return np.empty(0), np.empty((len(a), 0))
    v = np.linalg.qr(np.array(found[:most]).T)[0]
    e = np.einsum("ik,ij,jk->k", v, a, v)
    order = np.argsort(-e, kind="stable")
    order = order[e[order] > len(a) * EPS * scale]
    return e[order], v[:, order]


def whole(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors in a batch: the places of the rows that take part, and their entries in steps."""
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls are NaN
    first = np.cumsum(n) - n
    for d in np.unique(n[n > 0]).tolist():
        rows = np.flatnonzero(n == d)
        c = flat[first[rows][:, None] + np.arange(d)]
        sound = np.isfinite(c).all(axis=1)
        x = np.floor(SCALE * c[sound])
        if x.size and np.abs(x).max() > MOST:
            raise ValueError(f"a vector has an entry beyond {MOST} steps of 1/{SCALE}")
        yield rows[sound], x.astype(np.int64)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in as few bytes an entry as it needs: equal rows are equal bytes."""
    wide = np.maximum(x.max(axis=1), -1 - x.min(axis=1))
    out = [b""] * len(x)
    for kind, low, high in (("<i2", -1, 2**15), ("<i4", 2**15, 2**31), ("<i8", 2**31, LONG)):
        rows = np.flatnonzero((wide >= low) & (wide < high))
        data, size = x[rows].astype(kind).tobytes(), x.shape[1] * int(kind[2])
        for j, k in enumerate(rows.tolist()):
            out[k] = data[j * size : (j + 1) * size]
    return out


def unpacked(rows: list[bytes], d: int) -> np.ndarray:
    out = np.empty((len(rows), d), np.int64)
    for k, r in enumerate(rows):
        out[k] = np.frombuffer(r, f"<i{len(r) // d}")
    return out


def fit_list(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """dims and x (packed) of the distinct vectors, stored."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches, ROWS):
            for _, x in whole(b.column(0)):
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(packed(x), pa.binary())], names=["dims", "x"])

    return common.stored(vectors.select(column).mapInArrow(of, "dims int, x binary").distinct(), "whitening-vectors")


@dataclass
class Model:
    """What tasks need: n distinct vectors with their sums, the components as columns with their eigenvalues, and the
    greatest entry of the whitened fit list's covariance less the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def gaps(self, x: np.ndarray) -> np.ndarray:
        """n times the entries less their sums: longs where they fit, else Python's integers."""
        most = max(map(abs, self.sums)) + self.n * max(int(x.max()), -int(x.min())) if len(x) else 0
        kind = np.int64 if most < LONG else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def whitened(self, gaps: np.ndarray) -> np.ndarray:
        return (gaps / self.n).astype(np.float64) @ (self.vectors / np.sqrt(self.values))


def added(rows: DataFrame, of: Callable[[list[bytes]], np.ndarray], keys: int, exact: bool) -> np.ndarray:
    """A matrix of so many rows, the sum of what ``of`` gives for batches of x; each task sends one row a matrix row."""
    kind = np.dtype("<i8" if exact else "<f8")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in common.sliced(batches, ROWS):
            if b.num_rows:
                x = of(b.column(0).to_pylist())
                total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(keys, dtype=np.int32)), pa.array([r.astype(kind).tobytes() for r in total], pa.binary())], names=["k", "v"])

    def both(key: tuple, t: pa.Table) -> pa.Table:
        v = np.frombuffer(b"".join(t.column("v").to_pylist()), kind).reshape(t.num_rows, -1).sum(axis=0)
        return pa.table({"k": t.column("k")[:1].cast(pa.int32()), "v": pa.array([v.tobytes()], pa.binary())})

    made = rows.select("x").mapInArrow(partial, "k int, v binary").withColumn("part", F.spark_partition_id() % PARTS)
    made = made.groupBy("k", "part").applyInArrow(both, "k int, v binary").groupBy("k").applyInArrow(both, "k int, v binary")
    return np.array([np.frombuffer(r.v, kind) for r in sorted(made.collect(), key=lambda r: r.k)])


def covariance(rows: DataFrame, n: int, sums: list[int], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of the fit list, with divisor n. Entries are centred on a whole number near their mean before they are multiplied."""
    d = len(sums)
    near = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    most = int(max((high - near).max(), (near - low).max()))
    exact = n * most * most < LONG
    batch = max(1, EXACT // max(1, most * most))

    def product(rows: list[bytes]) -> np.ndarray:
        z = (unpacked(rows, d) - near).astype(np.float64)
        if not exact:
            return z.T @ z
        return sum((z[k : k + batch].T @ z[k : k + batch]).astype(np.int64) for k in range(0, len(z), batch))  # sums below 2**53

    g = added(rows, product, d, exact)
    rest = [s - n * int(c) for s, c in zip(sums, near, strict=True)]
    if not exact:
        r = np.array(rest, np.float64) / n
        return g / n - np.outer(r, r)
    r = np.array(rest, object)
    return ((n * g.astype(object) - np.outer(r, r)) / (n * n)).astype(np.float64)


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Model | None:
    """None where no vector takes part."""
    rows = fit_list(vectors, column)
    most = rows.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return None
    d, n = most.dims, most.n
    if d > DIMENSIONS:
        raise ValueError(f"vectors of {d} entries: more than {DIMENSIONS}")
    rows = rows.where(F.col("dims") == d)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, low, high = None, None, None
        for b in common.sliced(batches, ROWS):
            if b.num_rows:
                x = unpacked(b.column(0).to_pylist(), d)
                each = x.sum(axis=0), x.min(axis=0), x.max(axis=0)
                total, low, high = each if total is None else (total + each[0], np.minimum(low, each[1]), np.maximum(high, each[2]))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(total), pa.array(low), pa.array(high)], names=["k", "total", "low", "high"])

    made = rows.select("x").mapInArrow(of, "k int, total long, low long, high long").groupBy("k").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("k").collect()
    sums = [int(r.total) for r in made]
    v = covariance(rows, n, sums, np.array([r.low for r in made]), np.array([r.high for r in made]))
    e, q = principal(v, components)
    model = Model(n, sums, e, q, float(np.trace(v)))
    if len(e):

        def moments(rows: list[bytes]) -> np.ndarray:
            y = model.whitened(model.gaps(unpacked(rows, d)))
            return np.hstack([y.T @ y, y.sum(axis=0)[:, None]])

        w = added(rows, moments, len(e), False) / n
        model.identity_error = float(np.abs(w[:, :-1] - np.outer(w[:, -1], w[:, -1]) - np.eye(len(e))).max())
    return model


def transform(vectors: DataFrame, model: Model | None, column: str = "embedding", into: str = "whitened") -> DataFrame:
    """The rows with their whitened vector, null for those that take no part."""
    place = vectors.columns.index(column)
    names = [c for c in vectors.columns if c != into]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches, ROWS):
            out: list[list[float] | None] = [None] * b.num_rows
            for rows, x in whole(b.column(place)):
                if model is not None and len(rows) and x.shape[1] == len(model.sums):
                    for k, w in zip(rows.tolist(), model.whitened(model.gaps(x)).tolist(), strict=True):
                        out[k] = w
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(out, pa.list_(pa.float64()))], names=[*names, into])

    kept = ", ".join(f"`{c}` {t}" for c, t in vectors.dtypes if c != into)
    return vectors.mapInArrow(of, f"{kept}, `{into}` array<double>")


DIGEST = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def digest(vectors: DataFrame, model: Model | None, column: str = "embedding") -> DataFrame:
    """A row for each whitened row and component."""
    explained = (model.values / model.trace).tolist() if model is not None else []
    m = len(explained)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches, ROWS):
            for rows, x in whole(b.column(1)):
                if not m or not len(rows) or x.shape[1] != len(model.sums):
                    continue
                u = model.gaps(x)
                if u.dtype == object or int(np.abs(u).max()) ** 2 * x.shape[1] >= LONG:
                    deviation = [d if d < LONG else None for d in (u.astype(object) ** 2).sum(axis=1).tolist()]
                else:
                    deviation = (u * u).sum(axis=1).tolist()
                w = model.whitened(u)
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(np.repeat(rows, m))), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), n)), pa.array(np.full(n * m, model.n)),
                        pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(n), m))), pa.array(w.ravel()), pa.array(np.tile(explained, n)), pa.array(np.full(n * m, model.identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.select(F.col("vec_id").cast("long"), column).mapInArrow(of, DIGEST)
