"""Embedding whitening by shifted CholeskyQR.

Entries become integers ``x = floor(scale * c) + offset``. Every distinct vector is fitted
once; with n vectors and sums S the centred row is ``(n x - S) / n``, whose numerator is exact
in integers, so a large common offset costs no digits.

The centred rows A (n by d) are orthogonalised in passes. A pass solves the triangular systems
of all factors found so far for its rows (A R1^-1 R2^-1 ...), sums their Gram matrix in Spark
(one d by d sum per task, added by entry) and takes its Cholesky factor on the driver. The first
Gram matrix is shifted by a small multiple of its norm, so the factor exists however badly
conditioned the rows are; later ones are shifted only where Cholesky fails. The passes end when
the Gram matrix G is a projection (G G = G up to rounding: the identity, but for directions the
rows do not span, which shrink with every shifted pass). R = ... R2 R1 then has the singular
values and right singular vectors of A (with the root of the last Gram matrix before it, which says
what rounding left): its SVD gives the components (rows of V^T) and the
variances e = sigma^2 / n, without squaring the condition number. A row's whitened value
is its centred row projected on a component, over sqrt(e).

What reaches the driver is d^2 sums per pass; rows never do. A task holds one Arrow batch.

Defined cases: rows with a null vector, or one with null or non-finite entries, take no part;
shorter vectors (empty ones too) count as padded with zeros up to the longest; rows that share an
id, and rows without an id, each have their rows of output; repeated vectors are fitted once;
directions without variance (fewer distinct vectors than dimensions, constant columns) are no
components; with one distinct vector, or none, there is no component and no row; equal variances
leave their components free within the plane they span, one choice for all rows; a deviation
beyond 64 bits is null; extra columns are ignored. Entries must fit 64 bits after scaling.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, small_batches

SCALE = 64.0
OFFSET = 1_000_000
COMPONENTS = 16
MAX_PASSES = 8
_EPS = np.finfo(np.float64).eps
_DONE = 1e-12            # the Gram matrix is a projection up to this


def usable(df: DataFrame, id_col: str, vec_col: str, scale: float, offset: int) -> DataFrame:
    """(vec_id, x): rows that take part, as integers."""
    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("c"))
    return (rows.where(F.col("c").isNotNull() & ~F.coalesce(F.exists("c", bad), F.lit(False)))
            .select("vec_id", F.transform("c", lambda c: F.floor(c * scale).cast("long") + offset).alias("x")))


def matrix(column, dims: int, fill: int) -> np.ndarray:
    """An Arrow column of integer lists as rows of ``dims`` numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.full((len(size), dims), fill, dtype=np.int64)
    out[np.arange(dims) < size[:, None]] = flat
    return out


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverses of upper triangular ``factors``, by forward substitution."""
    for r in factors:
        q = np.empty_like(rows)
        for j in range(len(r)):
            q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        rows = q
    return rows


@dataclass
class Centre:
    n: int
    sums: np.ndarray          # exact, per dimension
    offset: int

    def numerators(self, column) -> np.ndarray:
        """n x - S of every row; exact while n times an entry fits 64 bits."""
        return self.n * matrix(column, len(self.sums), self.offset) - self.sums

    def rows(self, column) -> np.ndarray:
        return self.numerators(column) / self.n


def summed(fit: DataFrame, dims: int, part) -> np.ndarray:
    """Sum over all batches of ``part(column)``, an array of any fixed shape.

    Each task adds up its own batches; Spark adds the tasks by entry.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                one = part(b.column(0))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["pos", "v"])

    sums = fit.select("x").mapInArrow(run, "pos long, v double").groupBy("pos").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(sums.num_rows)
    out[sums.column("pos").to_numpy()] = sums.column("v").to_numpy()
    return out


def gram(fit: DataFrame, centre: Centre, factors: list[np.ndarray]) -> np.ndarray:
    dims = len(centre.sums)

    def part(column) -> np.ndarray:
        q = solved(centre.rows(column), factors)
        return q.T @ q

    g = summed(fit, dims, part).reshape(dims, dims)
    return (g + g.T) / 2


def cholesky(g: np.ndarray, n: int, always_shift: bool) -> np.ndarray:
    """Upper triangular R with R^T R = G, or G plus a shift where G alone does not do."""
    dims = len(g)
    least = 11 * (n * dims + dims * (dims + 1)) * _EPS * np.linalg.norm(g, 2)
    shift = min(least, 1e-3 * np.linalg.norm(g, 2)) if always_shift else 0.0
    for _ in range(60):
        try:
            return np.linalg.cholesky(g + shift * np.eye(dims)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, dims * _EPS * np.linalg.norm(g, 2))
    raise RuntimeError("no Cholesky factor: the Gram matrix is not finite")


@dataclass
class Whitening:
    centre: Centre
    components: np.ndarray    # dims by k, by falling variance
    variances: np.ndarray     # of the components
    explained: np.ndarray
    identity_error: float
    passes: int

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.components / np.sqrt(self.variances)


def fit_whitening(fit: DataFrame, k: int, offset: int) -> Whitening | None:
    """``fit``: a written table of distinct vectors ``x`` of one length. None where nothing varies."""
    n, dims = fit.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n or n < 2 or not dims:
        return None
    sums = {r["pos"]: r["s"] for r in fit.select(F.posexplode("x").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("s")).collect()}
    centre = Centre(n, np.array([sums[i] for i in range(dims)], dtype=np.int64), offset)

    factors: list[np.ndarray] = []
    r, total = np.eye(dims), 0.0
    while True:
        g = gram(fit, centre, factors)
        if not factors:
            total = float(np.trace(g))
            if not total > 0:
                return None
        elif len(factors) == MAX_PASSES or np.abs(g @ g - g).max() <= _DONE * dims:
            break
        factors.append(cholesky(g, n, always_shift=not factors))
        r = factors[-1] @ r
    # the last Gram matrix says what is left to orthogonalise, and which directions are empty
    w, u = np.linalg.eigh(g)
    _, sigma, vt = np.linalg.svd(np.sqrt(np.maximum(w, 0.0))[:, None] * (u.T @ r))
    keep = min(k, int((sigma > sigma[0] * max(n, dims) ** 0.5 * dims * _EPS * 16).sum()))
    variances = sigma[:keep] ** 2 / n
    out = Whitening(centre, vt[:keep].T.copy(), variances, variances / (total / n), 0.0, len(factors))

    def moments(column) -> np.ndarray:
        w = out.whitened(centre.rows(column))
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    m = summed(fit, dims, moments)
    second, mean = m[:keep * keep].reshape(keep, keep) / n, m[keep * keep:] / n
    out.identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(keep)).max())
    return out


def deviations(numerators: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None beyond 64 bits."""
    about = (numerators.astype(np.float64) ** 2).sum(axis=1)
    if not len(about) or about.max() < 2.0 ** 62:
        return (numerators * numerators).sum(axis=1).tolist()
    exact = [sum(v * v for v in row) for row in numerators.tolist()]
    return [e if e < 2 ** 63 else None for e in exact]


def whiten(vectors: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding",
           scale: float = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every row and component."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = settled(usable(vectors, id_col, vec_col, scale, offset), "whiten-rows")
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if dims:
        pad = F.array_repeat(F.lit(offset).cast("long"), F.lit(dims) - F.size("x"))
        rows = rows.withColumn("x", F.when(F.size("x") < dims, F.concat("x", pad)).otherwise(F.col("x")))
    # copies are combined in their own task before the shuffle
    distinct = settled(rows.select("x").distinct(), "whiten-fit")
    model = fit_whitening(distinct, k, offset)
    if model is None:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast(model)          # k vectors and the sums

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        count = len(m.variances)
        for b in batches:
            if not b.num_rows:
                continue
            numerators = m.centre.numerators(b.column(1))
            w = m.whitened(numerators / m.centre.n)
            each = np.repeat(np.arange(b.num_rows), count)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), b.num_rows)),
                 pa.array(np.full(len(each), m.centre.n)), pa.array(deviations(numerators), pa.int64()).take(pa.array(each)),
                 pa.array(w.ravel()), pa.array(np.tile(m.explained, b.num_rows)),
                 pa.array(np.full(len(each), m.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(score, schema)
