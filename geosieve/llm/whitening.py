"""Whitening of embeddings by a randomised range finder with power passes.

Entries become whole numbers, x = floor(256 * c), and the covariance V is that
of the distinct vectors. Its leading eigenvectors come from passes over all
centred rows:

1. A random block Q of COMPONENTS + OVERSAMPLING orthonormal columns.
2. A power pass: every task multiplies its rows' part of V with Q, and Spark sums
   the parts. Rayleigh-Ritz on the block gives the eigenpairs it holds and
   their residuals from the same product, which then, made orthonormal, is the
   next block.
3. Once each residual over its gap to the other eigenvalues, which bounds the
   error of the eigenvector, is within TOLERANCE, that is the answer. If PASSES
   passes don't reach it, as with spectra that fall slowly, the block is expanded
   to the full dimension: one more pass with Q the identity, for which
   Rayleigh-Ritz is exact.
4. One pass over the whitened rows measures how far their covariance is from the
   identity.

Rows are centred by the whole part of the mean first, in whole numbers, so a
large common offset costs no digits. Sums are exact at any size; the tasks'
partial products have as many entries as Q, in blocks of WIDTH columns that
Spark adds up, so the driver gets one matrix however many tasks there are.

Dropped are rows whose vector is null, empty, or holds a null or non-finite
entry, and rows of another length than the most frequent one (of equally frequent
lengths the largest). Entries past the range of a long are taken as its ends; a
deviation past it is null. Repeated vectors count once in the fit and each row has its
result. Null ids are kept. A component whose eigenvalue is zero up to rounding
can't be scaled and has no row, so a table with one distinct vector gives none, and
an empty table gives none. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, small_batches

SCALE, COMPONENTS, OVERSAMPLING, PASSES, TOLERANCE, SEED = 256, 4, 8, 3, 1e-11, 7
WIDTH = 16
_HALF = 1 << 32


@dataclass(frozen=True)
class Whitening:
    """What a fit found: n distinct vectors, their sums, and the components with their eigenvalues."""

    n: int
    sums: list[int]
    basis: np.ndarray  # dimension x components, unit columns
    values: np.ndarray
    trace: float
    identity_error: float
    passes: int
    expanded: bool


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & F.forall(vector, finite)


def whole(vector: Column, scale: int = SCALE) -> Column:
    """The entries times the scale, rounded down to longs."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Vectors of one length as rows."""
    return np.asarray(column.flatten()).reshape(-1, dimension)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n as doubles, the whole part of the mean taken off in whole numbers."""
    low = [s // n for s in sums]
    rest = np.array([(s - n * m) / n for s, m in zip(sums, low)])
    if max(map(abs, low), default=0) < 1 << 61 and (not x.size or max(int(x.max()), -int(x.min())) < 1 << 61):
        return (x - np.array(low, np.int64)) - rest
    return x.astype(float) - (np.array(low, float) + rest)


def summed(rows: DataFrame, dimension: int, height: int, width: int, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of what ``make`` gives for some of them, a height x width matrix."""
    blocks = -(-width // WIDTH)
    names = [f"c{i}" for i in range(WIDTH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, blocks * WIDTH))
        for b in batches:
            if b.num_rows:
                total[:, :width] += make(matrix(b.column("x"), dimension))
        parts = total.reshape(height * blocks, WIDTH)
        place = [pa.array(np.repeat(np.arange(height), blocks)), pa.array(np.tile(np.arange(blocks), height))]
        yield pa.RecordBatch.from_arrays([*place, *(pa.array(c) for c in parts.T)], names=["row", "block", *names])

    made = rows.mapInArrow(run, "row long, block long, " + ", ".join(f"{c} double" for c in names))
    out = np.zeros((height, blocks, WIDTH))
    for r in made.groupBy("row", "block").agg(*[F.sum(c).alias(c) for c in names]).collect():  # height x width numbers
        out[r.row, r.block] = r[2:]
    return out.reshape(height, -1)[:, :width]


def exact_sums(rows: DataFrame, dimension: int) -> list[int]:
    """The exact sum of each entry over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
        for b in batches:
            x = matrix(b.column("x"), dimension)
            high += (x >> 32).sum(axis=0)
            low += (x & (_HALF - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension)), pa.array(high), pa.array(low)], names=["row", "high", "low"])

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    got = {r.row: int(r.high) * _HALF + int(r.low) for r in rows.mapInArrow(run, "row long, high long, low long").groupBy("row").agg(*wide).collect()}
    return [got[i] for i in range(dimension)]


def leading(product: Callable[[np.ndarray], np.ndarray], dimension: int, components: int, oversampling: int, passes: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """Leading eigenvectors and values of a symmetric matrix known by its products; passes made, and whether the block was expanded."""
    width = min(dimension, components + oversampling)
    made = 0
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dimension, width)))[0]
    while width < dimension and made < passes:
        z = product(q)
        made += 1
        t = q.T @ z
        value, s = np.linalg.eigh((t + t.T) / 2)
        value, s = value[::-1], s[:, ::-1]
        u, residual = q @ s[:, :components], np.linalg.norm(z @ s[:, :components] - (q @ s[:, :components]) * value[:components], axis=0)
        gap = [min(abs(value[i] - x) for j, x in enumerate(value) if j != i) for i in range(components)]
        if all(r <= tolerance * g for r, g in zip(residual, gap)):
            return u, value[:components], made, False
        q = np.linalg.qr(z)[0]
    full = product(np.eye(dimension))
    value, s = np.linalg.eigh((full + full.T) / 2)
    return s[:, ::-1][:, :components], value[::-1][:components], made + 1, width < dimension


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS, oversampling: int = OVERSAMPLING, passes: int = PASSES, tolerance: float = TOLERANCE) -> Whitening | None:
    """The components of distinct vectors x of one length; none without rows."""
    n = rows.count()
    if not n:
        return None
    sums = exact_sums(rows, dimension)

    def product(q: np.ndarray) -> np.ndarray:
        def make(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            return c.T @ (c @ q)

        return summed(rows, dimension, dimension, q.shape[1], make) / n

    trace = float(summed(rows, dimension, dimension, 1, lambda x: (centred(x, n, sums) ** 2).sum(axis=0)[:, None]).sum()) / n
    basis, values, made, expanded = leading(product, dimension, min(components, dimension), oversampling, passes, tolerance)
    some = values > max(values.max(), 0.0) * dimension * np.finfo(float).eps
    basis, values = np.ascontiguousarray(basis[:, some]), values[some]
    k = len(values)
    scaled = basis / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, sums) @ scaled
        return np.column_stack([y.T @ y, y.sum(axis=0)])

    error = 0.0
    if k:
        m = summed(rows, dimension, k, k + 1, moments)
        mean = m[:, k] / n
        error = float(np.abs(m[:, :k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(n, sums, basis, values, trace, error, made, expanded)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sums of (n * x - sums) ** 2 by row, null past a long."""
    most = n * max(int(x.max()), -int(x.min())) + max(map(abs, sums)) if x.size else 0
    if most * most * max(x.shape[1], 1) < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    out = (((n * x.astype(object)) - np.array(sums, object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in out]


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", **settings) -> DataFrame:
    """A row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    small_batches(df.sparkSession)
    scratch = Scratch(df.sparkSession)
    rows = df.where(usable(F.col(vector))).select(F.col(vec_id).cast("long").alias("vec_id"), whole(F.col(vector)).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dimension = lengths["size"] if lengths else 0
    rows = rows.where(F.size("x") == dimension)
    model = fit(scratch.keep(rows.select("x").distinct()), dimension, **settings) if dimension else None
    scratch.drop(*scratch.kept.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in OUT.split(", ")]
        for b in batches:
            x = matrix(b.column("x"), dimension)
            k = len(model.values) if model else 0
            if not k or not len(x):
                continue
            y = (centred(x, model.n, model.sums) @ model.basis) / np.sqrt(model.values)
            each = lambda column: column.take(pa.array(np.repeat(np.arange(len(x)), k)))
            m = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [
                    each(b.column("vec_id")),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(m, model.n)),
                    each(pa.array(deviations(x, model.n, model.sums), pa.int64())),
                    pa.array(y.reshape(-1)),
                    pa.array(np.tile(model.values / model.trace, len(x))),
                    pa.array(np.full(m, model.identity_error)),
                ],
                names=names,
            )

    return rows.mapInArrow(run, OUT)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding with its whitened coordinates on the leading components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
