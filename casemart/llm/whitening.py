"""Whitening of embeddings by shifted CholeskyQR.

Every vector becomes integers (``floor(scale * c) + offset``).  Row counts and
sums per dimension are exact, so a centred entry ``(n * x - sum) / n`` is
rounded once, however large the common offset is.  The centred rows C are then
orthogonalised without ever being together in one place:

1. a Gram pass adds up ``C'C``; its Cholesky factor R1, with a shift on the
   diagonal that makes it exist for any conditioning, gives Q1 = C inv(R1);
2. further Gram passes over the rows of Q (each task solves the triangular
   systems of all factors so far) give R2, R3, ... until ``Q'Q`` is the
   identity, or a projection where dimensions depend on each other;
3. R = ... R3 R2 R1 has the singular values and right vectors of C; its SVD
   gives the components and, squared and over n, their variances.

Squaring C's condition number, as an eigenvalue routine on the covariance does,
is thus avoided.  A last pass projects every row; the covariance of what comes
out is measured, not assumed.

Distribution: a pass is one scan.  Each task adds up its Gram matrix in numpy
and emits it once; equal places of all tasks are added by a grouped sum, which
spreads over the places.  The driver holds a few matrices of dimensions squared.

Edge cases: rows are dropped whose vector is null, empty, of another length
than the longest (its missing entries are nulls), or holds null or non-finite
entries, or entries of 2 ** 40 or more, which the integers could not hold.  A
row with a null id takes part.  Repeated rows count as often as they occur.
Components without variance (constant or dependent dimensions, a single row)
are not returned; an empty table, or one without variance, gives an empty
result.  A deviation that does not fit a long is null.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import query, read
from casemart.session import stage_table

_EPS = np.finfo(float).eps
#: Numbers that a task centres at once.
CHUNK = 1 << 18


def integer_rows(df: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """``(vec_id, x array<long>)`` of the usable rows; all x have the same length."""
    def usable(c: Column) -> Column:
        return F.coalesce(F.abs(c.cast("double")) < float(1 << 40), F.lit(False))      # false for NaN and infinity, too

    rows = (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
            .filter(F.col("v").isNotNull() & (F.size("v") > 0)))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return (rows.filter((F.size("v") == width) & F.forall("v", usable))
            .select("vec_id", F.transform("v", lambda c: F.floor(scale * c.cast("double")).cast("long") + offset).alias("x")))


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """``(ids, integer rows)`` in pieces of at most ``CHUNK`` numbers (one row at least)."""
    step = max(1, CHUNK // max(width, 1))
    for b in batches:
        x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        for at in range(0, len(x), step):
            yield b.column("vec_id").slice(at, step), x[at:at + step]


def _total(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum of ``of(integer rows)`` over all rows; each task adds up its own."""
    def add(batches):
        total = None
        for _, x in _matrices(batches, width):
            part = of(x).ravel()
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64() if kind == "long" else pa.float64()))], names=["part"])

    summed = "decimal(38,0)" if kind == "long" else "double"
    places = (rows.mapInArrow(add, f"part array<{kind}>").select(F.posexplode("part").alias("at", "value"))
              .groupBy("at").agg(F.sum(F.col("value").cast(summed)).alias("value")).orderBy("at").collect())
    return np.array([r["value"] for r in places], object if kind == "long" else float)


def _solve(c: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``c inv(r)`` for an upper triangular r, column by column."""
    q = np.empty(c.shape, order="F")
    for j in range(c.shape[1]):
        q[:, j] = (c[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of ``gram + shift``; the shift grows until the factor exists."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, _EPS * float(np.trace(gram)))


@dataclass(frozen=True)
class Centre:
    """Exact mean: integer sums over ``n`` rows."""

    n: int
    sums: tuple[int, ...]
    largest: int          # of |x|

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sum``, exact (as Python integers where longs are too short)."""
        if 2 * self.n * max(self.largest, 1) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        d = self.numerators(x)
        if d.dtype != object and x.shape[1] * int(np.abs(d).max(initial=0)) ** 2 < 1 << 62:
            return pa.array((d * d).sum(1))
        exact = [sum(v * v for v in row) for row in d.astype(object).tolist()]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    trace: float              # of the covariance
    variances: np.ndarray     # falling
    components: np.ndarray    # unit columns, in the order of the variances
    passes: int

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        return self.centre.rows(x) @ (self.components[:, :k] / np.sqrt(self.variances[:k]))


def learn_whitening(rows: DataFrame, most: int = 12) -> Whitening | None:
    """Components of (vec_id, x) rows, which should be stored: they are read once a pass."""
    head = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d"), F.max(F.array_max(F.transform("x", F.abs))).alias("m")).first()
    if not head.n:
        return None
    n, d = head.n, head.d
    sums = _total(rows, d, lambda x: x.sum(0), "long")
    centre = Centre(n, tuple(int(s) for s in sums), int(head.m))
    factors: list[np.ndarray] = []
    r, trace = np.eye(d), 0.0
    for turn in range(most):
        def gram_of(x, done=tuple(factors)):
            q = centre.rows(x)
            for f in done:
                q = _solve(q, f)
            return q.T @ q

        gram = _total(rows, d, gram_of, "double").reshape(d, d)
        gram = (gram + gram.T) / 2
        if not turn:
            trace = float(np.trace(gram))
            if not trace > 0:
                return None
            # a shift with which the first factor exists; never more than a small share of the whole
            shift = min(11 * (n * d + d * (d + 1)) * _EPS / 2, 1e-6) * trace
        elif np.abs(gram @ gram - gram).max() <= 8 * d * _EPS:
            break
        else:
            shift = 0.0
        factors.append(_cholesky(gram, shift))
        r = factors[-1] @ r
    _, singular, vt = np.linalg.svd(r)
    live = singular ** 2 > singular[0] ** 2 * d * _EPS
    v = vt[live].T
    v = v * np.where(v[np.abs(v).argmax(0), np.arange(v.shape[1])] < 0, -1.0, 1.0)       # either sign would do; keep one
    return Whitening(centre, trace / n, singular[live] ** 2 / n, v, turn + 1)


def identity_error(rows: DataFrame, model: Whitening, k: int) -> float:
    """Largest entry of the covariance of the first k whitened components, minus the identity."""
    d = len(model.centre.sums)

    def moments(x):
        w = model.project(x, k)
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    total = _total(rows, d, moments, "double") / model.centre.n
    mean, second = total[:k], total[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row per usable row and component."""
    rows = stage_table(integer_rows(df, id_col, vector_col, scale, offset), "whitening-rows")
    kind = f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = learn_whitening(rows)
    k = min(components, len(model.variances)) if model else 0
    if not k:
        return rows.sparkSession.createDataFrame([], kind)
    error, d = identity_error(rows, model, k), len(model.centre.sums)
    explained = model.variances[:k] / model.trace

    def apply(batches):
        for ids, x in _matrices(batches, d):
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.centre.n, np.int64)),
                 model.centre.deviations(x).take(each), pa.array(model.project(x, k).ravel()), pa.array(np.tile(explained, m)),
                 pa.array(np.full(m * k, error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(apply, kind)


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark, sf_dir):
    return whiten(read(spark, sf_dir, "embeddings"))
