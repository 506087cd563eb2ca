"""Embedding whitening by shifted Cholesky QR.

1. Vectors become whole numbers (``grid``); rows, exact sums per dimension and
   the largest magnitude are counted in one pass.
2. Gram passes: every task adds the products of its centred rows, the tasks'
   matrices are added row by row in parallel, and the d x d total comes to the
   driver.  Its Cholesky factor R makes the rows more orthogonal: the next pass
   sends each row through the triangular solves of all factors so far.  The
   first factor, and any whose matrix is not safely positive, is that of the
   matrix plus a small shift, so ill-conditioned rows need a further pass
   instead of failing.  A Gram matrix near the identity ends the passes.
3. The factors are composed, A = Q R, and the SVD of R gives the singular
   values and right singular vectors of A: the whitening components.
4. A last Gram pass over the whitened rows measures how far their covariance
   is from the identity; the output pass projects every row.

Only d x d matrices and d sums reach the driver (2 MB for 512 dimensions);
rows never do, and every pass is a scan without a shuffle of rows.

Edge cases: rows whose vector is null or empty, or holds a null or non-finite
entry, are dropped, and so are rows with an entry whose grid number reaches
2**52 (it stands for no exact double).  Vectors of another length than the
commonest one (the longest of equally common ones) are dropped.  Constant
dimensions have no weight in any component; directions without variance give
no component, so fewer than ``k`` may come back, none if all rows are equal.
Repeated rows and null ids count as rows of their own; of equal eigenvalues
any basis may come.  ``deviation`` is null where 38 digits do not hold it.  An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import Shared

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
MOST_PASSES = 12
EXACT = 1 << 52
PANEL = 64


def grid(entry: Column) -> Column:
    """The whole number floor(1024 * entry) + 100000."""
    return F.floor(F.lit(float(SCALE)) * entry.cast("double")).cast("bigint") + F.lit(OFFSET)


def usable(vector: Column) -> Column:
    """True for vectors without null, non-finite and out-of-grid entries."""
    bound = float(EXACT // SCALE - OFFSET)
    return F.coalesce((F.size(vector) > 0) & F.forall(
        vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < bound), F.lit(False))), F.lit(False))


def solve_rows(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Y with Y @ factor = rows for an upper triangular factor, panel by panel."""
    out = np.array(rows, order="F")
    for s in range(0, len(factor), PANEL):
        e = min(s + PANEL, len(factor))
        if s:
            out[:, s:e] -= out[:, :s] @ factor[:s, s:e]
        for j in range(s, e):
            if j > s:
                out[:, j] -= out[:, s:j] @ factor[s:j, j]
            out[:, j] /= factor[j, j]
    return out


@dataclass
class Frame:
    """What a task needs to turn grid vectors into rows: exact sums, the
    dimensions with any variance, the factors so far, and in the end the
    components with their scales."""

    n: int
    sums: list[int]
    largest: int
    active: np.ndarray | None = None
    factors: list[np.ndarray] = field(default_factory=list)
    components: np.ndarray | None = None

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit numbers where they hold it, else Python's."""
        if 2 * self.n * self.largest < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows through all factors, or projected on the components."""
        centred = self.offsets(x).astype(np.float64) / self.n
        if self.components is not None:
            return centred @ self.components
        if self.active is not None:
            centred = centred[:, self.active]
        for factor in self.factors:
            centred = solve_rows(centred, factor)
        return centred


def deviations(offsets: np.ndarray) -> pa.Array:
    """Exact sums of squares per row, as decimal(38, 0)."""
    most = int(abs(offsets).max()) if offsets.size else 0
    if offsets.shape[1] * most * most < 1 << 63:
        return pa.array((offsets.astype(np.int64) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
    whole = [sum(v * v for v in map(int, row)) for row in offsets]
    return pa.array([Decimal(v) if v < 10 ** 38 else None for v in whole], pa.decimal128(38, 0))


def vectors_of(batch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy().reshape(len(x), -1)


def grid_rows(rows: DataFrame, column: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """vec_id, x: usable vectors of the commonest length on the grid."""
    kept = rows.select(F.col(id_column).alias("vec_id"), F.col(column).alias("x")).filter(usable(F.col("x")))
    length = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return kept.filter(F.size("x") == (length["d"] if length else 0)).select("vec_id", F.transform("x", grid).alias("x"))


def totals(rows: DataFrame) -> Frame | None:
    """Exact sums of every dimension, number of rows and largest magnitude."""
    def add(batches):
        n, high, low, most = 0, None, None, 0
        for b in batches:
            x = vectors_of(b)
            if len(x):
                parts = (x >> 26).sum(axis=0), (x & (1 << 26) - 1).sum(axis=0)
                high, low = parts if high is None else (high + parts[0], low + parts[1])
                n, most = n + len(x), max(most, int(np.abs(x).max()))
        if n:
            d = len(high)
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(high), pa.array(low),
                                              pa.array([n] * d, pa.int64()), pa.array([most] * d, pa.int64())],
                                             ["i", "high", "low", "n", "most"])

    found = rows.select("x").mapInArrow(add, "i int, high bigint, low bigint, n bigint, most bigint").groupBy("i").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n"), F.max("most").alias("most"))
    sums = sorted(found.collect())
    if not sums:
        return None
    return Frame(sums[0]["n"], [(r["high"] << 26) + r["low"] for r in sums], sums[0]["most"])


def gram(rows: DataFrame, frame: Frame) -> np.ndarray:
    """Sum of y y' over the rows y that ``frame`` makes.

    The tasks' matrices meet row by row: one group holds one row a task."""
    shared = Shared(rows.sparkSession, frame)

    def add(batches):
        total = None
        for b in batches:
            y = shared.value.rows(vectors_of(b))
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            from pyspark import TaskContext
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([part] * len(total), pa.int32()),
                 pa.array(list(total), pa.list_(pa.float64()))], ["i", "part", "row"])

    def merge(table):
        table = table.sort_by("part")
        row = np.stack(table.column("row").to_numpy()).sum(axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "row": pa.array([row], pa.list_(pa.float64()))})

    found = rows.select("x").mapInArrow(add, "i int, part int, row array<double>").groupBy("i").applyInArrow(
        merge, "i int, row array<double>").collect()
    return np.array([r["row"] for r in sorted(found, key=lambda r: r["i"])])


def factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper Cholesky factor of ``g``, of ``g`` plus a shift if asked for or needed."""
    d, unit = len(g), np.finfo(np.float64).eps / 2
    if not shifted:
        try:
            return np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            pass
    shift = 11 * (n * d + d * (d + 1)) * unit * np.linalg.norm(g, 2)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


@dataclass
class Whitening:
    frame: Frame
    explained: np.ndarray
    passes: int
    identity_error: float = 0.0


def fit(rows: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """Components of the grid rows; None without rows."""
    frame = totals(rows)
    if frame is None:
        return None
    d = len(frame.sums)
    g = gram(rows, frame)
    trace = float(np.trace(g))
    frame.active = np.flatnonzero(np.diag(g) > 0)
    # dimensions of unlike scale: the first factor holds their norms
    norms = np.sqrt(np.diag(g)[frame.active])
    g = g[np.ix_(frame.active, frame.active)] / np.outer(norms, norms)
    r, passes = np.diag(norms), 1
    if len(norms):
        r1 = factor(g, frame.n, shifted=True)
        frame.factors, r = [r], r1 @ r
        frame.factors.append(r1)
    while len(norms) and passes < MOST_PASSES:
        g = gram(rows, frame)
        passes += 1
        near = float(np.abs(g - np.eye(len(g))).max())
        ri = factor(g, frame.n, shifted=near > 0.5 and np.linalg.eigvalsh(g)[0] < 1e-6)
        frame.factors.append(ri)
        r = ri @ r
        if near < 1e-6:
            break
    _, sigma, axes = np.linalg.svd(r) if len(norms) else (None, np.zeros(0), np.zeros((0, 0)))
    kept = [i for i in range(min(k, len(sigma))) if sigma[i] > sigma[0] * d * np.finfo(np.float64).eps]
    components = np.zeros((d, len(kept)))
    for c, i in enumerate(kept):
        axis = axes[i] * (1 if axes[i][np.argmax(np.abs(axes[i]))] > 0 else -1)
        components[frame.active, c] = axis / (sigma[i] / np.sqrt(frame.n))
    frame.components = components
    found = Whitening(frame, np.array([sigma[i] ** 2 / trace for i in kept]), passes)
    if kept:
        found.identity_error = float(np.abs(gram(rows, frame) / frame.n - np.eye(len(kept))).max())
    return found


def whiten(rows: DataFrame, column: str = "embedding", id_column: str = "vec_id", k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained,
    identity_error for every usable row and component."""
    points = grid_rows(rows, column, id_column)
    kind = points.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    found = fit(points, k)
    if found is None:
        return rows.sparkSession.createDataFrame([], schema)
    shared = Shared(rows.sparkSession, found)

    def project(batches):
        model = shared.value
        m = len(model.explained)
        for b in batches:
            x = vectors_of(b)
            if not len(x) or not m:
                continue
            at = pa.array(np.repeat(np.arange(len(x)), m))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(at), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(at), model.frame.n)), deviations(model.frame.offsets(x)).take(at),
                 pa.array(model.frame.rows(x).ravel()), pa.array(np.tile(model.explained, len(x))),
                 pa.array(np.full(len(at), model.identity_error))], schema_names)

    schema_names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return points.mapInArrow(project, schema)
