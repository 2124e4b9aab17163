"""Whitening of embeddings: pivoted Cholesky, then one-sided Jacobi.

The covariance of the distinct vectors is summed by Spark: every task centres
its vectors on the mean before it multiplies them, and the tasks' matrices
(one of ``d x d`` for vectors of length ``d``) are added up row by row.  What
reaches the driver is one such matrix, whatever the number of vectors.  There
it is factored by pivoted Cholesky, and one-sided Jacobi rotations are applied
directly to the triangular factor until its columns are orthogonal: their
squared norms are the eigenvalues, the normalised columns the components.
The covariance is never squared and no rotation touches it, so small
eigenvalues keep their relative accuracy.

Defined results: vectors that are null or hold null, NaN or infinite entries
are dropped, empty vectors have no components; rows that repeat an id or have
a null id each return their own rows; equal vectors count once in the fit and
are all returned; equal eigenvalues are numbered in some order, the same for
all rows; components without variance (eigenvalue not above rounding) do not
exist, so a single distinct vector or constant vectors return no row; vectors
of several lengths are whitened length by length; entries beyond 2**55 in size
saturate; ``deviation`` is null where it does not fit a long; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_table

#: Entries of the matrix that a task multiplies at once.
SLICE = 1 << 21
#: Partial matrices are first added up in so many groups, then these.
GROUPS = 32


# ---- the decomposition of one small matrix ----------------------------------

def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``g`` with ``g @ g.T == a``; in the order of its pivots ``g`` is lower triangular."""
    d = len(a)
    g, left, open_ = np.zeros((d, d)), np.diagonal(a).copy(), np.ones(d, bool)
    least = d * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    for k in range(d):
        pivot = int(np.argmax(np.where(open_, left, -np.inf)))
        if not left[pivot] > least:
            return g[:, :k]
        column = a[:, pivot] - g[:, :k] @ g[pivot, :k]
        root = math.sqrt(left[pivot])
        g[:, k] = np.where(open_, column / root, 0.0)
        g[pivot, k] = root
        open_[pivot] = False
        left -= g[:, k] ** 2
    return g


def rounds(r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``r`` columns in rounds of disjoint pairs."""
    ring = list(range(r + r % 2))
    out = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(p, q) for p, q in zip(ring[:half], reversed(ring[half:])) if p < r and q < r]
        out.append((np.array([p for p, _ in pairs], int), np.array([q for _, q in pairs], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotate the columns of ``g`` pair by pair until all are orthogonal."""
    g = g.copy()
    order = rounds(g.shape[1])
    small = np.finfo(float).eps * math.sqrt(max(g.shape[0], 1))
    for _ in range(sweeps):
        turned = False
        for p, q in order:
            x, y = g[:, p], g[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            skew = np.abs(xy) > small * np.sqrt(xx * yy)
            if not skew.any():
                continue
            turned = True
            p, q, x, y = p[skew], q[skew], x[:, skew], y[:, skew]
            zeta = (yy[skew] - xx[skew]) / (2 * xy[skew])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            g[:, p], g[:, q] = c * (x - t * y), c * (t * x + y)
        if not turned:
            return g
    raise ArithmeticError("Jacobi rotations did not converge")


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding, falling, and unit eigenvectors as columns."""
    g = one_sided_jacobi(pivoted_cholesky(a))
    norms = np.sqrt((g * g).sum(0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] ** 2 > len(a) * np.finfo(float).eps * (norms.max(initial=0.0) ** 2)]
    return norms[order] ** 2, g[:, order] / norms[order]


# ---- sums over all vectors ---------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """The fit of one vector length: ``components`` has a column for each."""
    n: int
    sums: tuple
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact (Python integers where longs could overflow)."""
        most = max([abs(s) for s in self.sums] + [1]) + self.n * int(np.abs(x.astype(float)).max(initial=0.0) + 1)
        kind = np.int64 if most < 2 ** 62 else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def values(self, x: np.ndarray) -> np.ndarray:
        off = self.centred(x)
        return (off / self.n).astype(float) @ self.components / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        off = self.centred(x)
        if float(np.abs(off.astype(float)).max(initial=0.0)) ** 2 * max(x.shape[1], 1) >= 2 ** 62:
            off = off.astype(object)
        return [int(v) if v < 2 ** 63 else None for v in (off * off).sum(1)]


def matrices(batch: pa.RecordBatch, column: str):
    """Rows and vectors of a batch by length: (row numbers, long matrix), in bounded slices."""
    lists = batch.column(column)
    sizes = np.asarray(lists.value_lengths())
    starts = np.asarray(lists.offsets)[:-1]
    flat = np.asarray(lists.values)
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == d)
        for at in range(0, len(rows), max(1, SLICE // int(d))):
            some = rows[at:at + max(1, SLICE // int(d))]
            yield some, flat[starts[some][:, None] + np.arange(d)]


def integer_vectors(df: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """The usable rows with ``x``, the vector in whole steps of ``1 / scale``."""
    ok = F.forall(vector_col, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    steps = F.transform(vector_col, lambda c: F.floor(F.lit(scale) * c.cast("double")))
    return df.where(F.col(vector_col).isNotNull() & ok).withColumn("x", steps)


def column_sums(fit: DataFrame) -> dict[int, tuple[int, tuple]]:
    """``length: (rows, sums by dimension)``, exact."""
    def partial(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            for _, x in matrices(batch, "x"):
                n, s = totals.get(x.shape[1], (0, 0))
                safe = float(np.abs(x.astype(float)).max(initial=0.0)) * len(x) < 2 ** 62
                totals[x.shape[1]] = (n + len(x), s + (x if safe else x.astype(object)).sum(0).astype(object))
        for d, (n, s) in totals.items():
            yield pa.RecordBatch.from_pydict({"d": [d] * d, "i": range(d), "n": [n] * d, "s": [str(v) for v in s]})

    parts = fit.select("x").mapInArrow(partial, "d long, i long, n long, s string")
    total = (parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
             .collect())  # a row a dimension
    out: dict[int, tuple[int, tuple]] = {}
    for r in sorted(total, key=lambda r: (r.d, r.i)):
        n, s = out.get(r.d, (r.n, ()))
        out[r.d] = (n, (*s, int(r.s)))
    return out


def scatter(fit: DataFrame, sums: dict[int, tuple[int, tuple]]) -> dict[int, np.ndarray]:
    """``length: sum of (x - mean)(x - mean)T``; a task sends a matrix a length."""
    means = {d: np.array([v / n for v in s]) for d, (n, s) in sums.items()}

    def partial(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in matrices(batch, "x"):
                off = x - means[x.shape[1]]
                totals[x.shape[1]] = totals.get(x.shape[1], 0.0) + off.T @ off
        for d, m in totals.items():
            yield pa.RecordBatch.from_pydict({"d": [d] * d, "i": range(d), "row": list(m)},
                                             pa.schema([("d", pa.int64()), ("i", pa.int64()),
                                                        ("row", pa.list_(pa.float64()))]))

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.asarray(r) for r in pdf["row"]], axis=0)
        return pd.DataFrame({"d": pdf["d"][:1], "i": pdf["i"][:1], "row": [total]})

    schema = "d long, i long, row array<double>"
    parts = fit.select("x").mapInArrow(partial, schema).withColumn("g", F.spark_partition_id() % GROUPS)
    some = parts.groupBy("d", "i", "g").applyInPandas(lambda pdf: added(pdf), schema)
    rows = some.groupBy("d", "i").applyInPandas(lambda pdf: added(pdf), schema).collect()
    return {d: np.array([r.row for r in sorted((r for r in rows if r.d == d), key=lambda r: r.i)]) for d in sums}


def fit_whitening(fit: DataFrame, components: int) -> dict[int, Whitening]:
    """A model a vector length, from the distinct vectors ``x``."""
    sums = column_sums(fit)
    models = {}
    for d, total in scatter(fit, sums).items():
        n, s = sums[d]
        v = total / n
        e, u = eigen((v + v.T) / 2)
        models[d] = Whitening(n, s, u[:, :components], e[:components], math.fsum(np.diagonal(v)))
    return models


def project(df: DataFrame, models: dict[int, Whitening], keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``d, values, deviation`` of every row of ``x``."""
    kept = df.select(*keep, "x")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "x"]

    def run(batches):
        for batch in batches:
            for rows, x in matrices(batch, "x"):
                m = models[x.shape[1]]
                own = batch.take(pa.array(rows)).select(keep)
                out = {f: own.column(f) for f in keep}
                out |= {"d": pa.array([x.shape[1]] * len(x), pa.int64()),
                        "values": pa.array(list(m.values(x)), pa.list_(pa.float64())),
                        "deviation": pa.array(m.deviations(x), pa.int64())}
                yield pa.RecordBatch.from_pydict(out)

    return kept.mapInArrow(run, ", ".join([*fields, "d long", "values array<double>", "deviation long"]))


def identity_errors(fit: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """Largest entry of the whitened fit list's covariance minus the identity, measured."""
    most = max((len(m.eigenvalues) for m in models.values()), default=0)
    pairs = [(i, j) for i in range(most) for j in range(i, most)]
    if not pairs:
        return {d: 0.0 for d in models}
    at = lambda i: F.get("values", F.lit(i))  # noqa: E731  null where a length has fewer components
    rows = (project(fit, models, []).groupBy("d")
            .agg(*[F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i, j in pairs]).collect())  # a row a length
    return {r.d: max([abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None], default=0.0)
            for r in rows}


def whiten(df: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    A row for each usable vector and component, numbered from 1 by falling
    eigenvalue; see the module for the results of odd input.
    """
    spark = df.sparkSession
    rows = integer_vectors(df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")), "v", scale)
    fit = scratch_table(rows.select("x").distinct(), "whiten-fit")
    models = fit_whitening(fit, components)
    errors = identity_errors(fit, models)
    facts = spark.createDataFrame(  # a row a length and component
        [(d, k, m.n, float(e / m.trace), float(errors.get(d, 0.0)))
         for d, m in models.items() for k, e in enumerate(m.eigenvalues)],
        "d long, k int, n long, explained double, identity_error double")
    each = project(rows, models, ["vec_id"]).select("vec_id", "d", "deviation", F.posexplode("values").alias("k", "whitened"))
    return each.join(facts, ["d", "k"]).select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", "deviation", "whitened", "explained",
        "identity_error")
