"""Embedding whitening: leading principal components of all vectors, scaled to unit variance.

1. *Moments.* Each task centres its batches on their own mean before it multiplies, and merges the
   batches' counts, sums, means and centred products; a second round of tasks merges the results of
   about the root of their number each, so the driver receives few matrices of ``d * d``, whatever the
   number of rows. Sums of whole-numbered vectors are exact.
2. *Components*, on the driver, of that one matrix: Householder reflections make it tridiagonal; Sturm
   counts bisect for the leading eigenvalues; inverse iteration gives their vectors, made orthogonal
   again within clusters of close eigenvalues; the reflections turn them back. The largest entry of a
   component is positive, so a rerun gives the same signs.
3. *Projection.* Mean, components and scales (``d * k`` numbers) go to all tasks in their closure.

Bounds: a task holds one batch and three ``d * d`` matrices, the driver about the root of the number
of tasks of them (32 KB each for 64 dimensions).

Rows whose vector is null, empty or holds null or non-finite entries take no part, nor do vectors of
another length than most (of equally many, the shorter). A component without variance (eigenvalue of
rounding size) explains 0 and its ``whitened`` is null. Repeated rows count as often as they stand; a
null id passes through. Entries whose whole number does not fit 64 bits raise an error. Without rows
there are no components and no results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import column
from tidemark.llm.registry import register, table

#: Rows centred and multiplied at a time.
BLOCK = 8192
_PARTIAL = "n long, sums array<long>, means array<double>, products array<double>"


def quantise(rows: DataFrame, vector: str = "embedding", scale: int = 1024, offset: int = 100000, out: str = "x") -> DataFrame:
    """Append ``floor(scale * c) + offset`` of each entry as whole numbers; rows that take no part go."""
    entry = F.col(vector).cast("array<double>")
    fit = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(
        F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    )
    kept = fit.withColumn(out, F.transform(entry, lambda c: F.floor(c * scale).cast("long") + F.lit(offset).cast("long")))
    common = fit.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).first()
    return kept.where(F.size(vector) == (common["d"] if common else 0))


def _matrix(values: pa.Array) -> np.ndarray:
    """The rows of an Arrow list column; all lists have one length."""
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


@dataclass
class Moments:
    """Count, sums, means and centred products of some vectors."""

    n: int
    sums: np.ndarray
    means: np.ndarray
    products: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> "Moments":
        """Of one block, centred on its own mean before multiplying."""
        n = len(x)
        sums = x.sum(axis=0)
        if x.dtype.kind == "i":
            base = sums // n
            rest = (sums - base * n) / n
            centred, means = (x - base) - rest, base + rest
        else:
            means = sums / n
            centred = x - means
        return Moments(n, sums, means, centred.T @ centred)

    def merge(self, other: "Moments | None") -> "Moments":
        if other is None:
            return self
        n = self.n + other.n
        apart = other.means - self.means
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.sums + other.sums, self.means + apart * (other.n / n), products)

    def row(self) -> pa.RecordBatch:
        lists = [pa.ListArray.from_arrays(pa.array([0, v.size], pa.int32()), pa.array(v.ravel())) for v in (self.sums, self.means, self.products)]
        return pa.RecordBatch.from_arrays([pa.array([self.n], pa.int64()), *lists], ["n", "sums", "means", "products"])

    @staticmethod
    def parse(row) -> "Moments":
        d = len(row["sums"])
        return Moments(row["n"], np.array(row["sums"]), np.array(row["means"]), np.array(row["products"]).reshape(d, d))


def moments(vectors: DataFrame, vector: str) -> Moments | None:
    """The moments of all vectors of one length, from per-task results merged in two rounds."""
    kind = dict(vectors.dtypes)[vector]
    schema = _PARTIAL if kind == "array<bigint>" else _PARTIAL.replace("sums array<long>", "sums array<double>")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(column(batch, vector)) if batch.num_rows else np.zeros((0, 0))
            for begin in range(0, len(x), BLOCK):
                total = Moments.of(x[begin : begin + BLOCK]).merge(total)
        if total is not None:
            yield total.row()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(batch.num_rows):
                total = Moments.parse(batch.slice(i, 1).to_pylist()[0]).merge(total)
        if total is not None:
            yield total.row()

    scan = vectors.select(vector)
    parts = scan.mapInArrow(gather, schema)
    groups = int(np.ceil(np.sqrt(scan.rdd.getNumPartitions())))
    total = None
    for row in parts.repartition(groups).mapInArrow(merge, schema).toLocalIterator():
        total = Moments.parse(row).merge(total)
    return total


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors that bring symmetric ``a`` to that form."""
    a = a.copy()
    d = len(a)
    reflections = []
    for j in range(d - 2):
        v = a[j + 1 :, j].copy()
        length = np.linalg.norm(v)
        v[0] += np.copysign(length, v[0])
        size = np.linalg.norm(v)
        if size > 0:
            v /= size
            rest = a[j + 1 :, j + 1 :]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[j + 1, j] = a[j, j + 1] = -np.copysign(length, a[j + 1, j])
        reflections.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflections


def count_below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``x``: the negative terms of the Sturm sequence."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q = diagonal[0] - x
    below = (q < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < tiny, np.where(q < 0, -tiny, tiny), q)
        q = diagonal[i] - x - off[i - 1] ** 2 / q
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues of a tridiagonal matrix, falling, bisected to double precision."""
    d = len(diagonal)
    radius = np.r_[np.abs(off), 0] + np.r_[0, np.abs(off)]
    low = np.full(k, (diagonal - radius).min())
    high = np.full(k, (diagonal + radius).max())
    low, high = low - np.abs(low) * 1e-12 - 1e-300, high + np.abs(high) * 1e-12 + 1e-300
    rank = d - np.arange(k)  # so many eigenvalues are no larger than the one sought
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        above = count_below(diagonal, off, middle) >= rank
        high = np.where(above, middle, high)
        low = np.where(above, low, middle)


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solve ``(T - shift) x = b`` by elimination with row exchanges; pivots are ``least`` at least."""
    d = len(diagonal)
    main, up, up2, x = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * d, b.tolist()
    low = off.tolist()
    for i in range(d - 1):
        if abs(low[i]) > abs(main[i]):
            factor = main[i] / low[i]
            main[i], main[i + 1], up[i] = low[i], up[i] - factor * main[i + 1], main[i + 1]
            up2[i], up[i + 1] = up[i + 1], -factor * up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            if abs(main[i]) < least:
                main[i] = least
            factor = low[i] / main[i]
            main[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
    for i in range(d - 1, -1, -1):
        value = x[i]
        if i + 1 < d:
            value -= up[i] * x[i + 1]
        if i + 2 < d:
            value -= up2[i] * x[i + 2]
        x[i] = value / (main[i] if abs(main[i]) >= least else least)
    return np.array(x)


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (as rows) by inverse iteration; those of close values are made orthogonal again."""
    d = len(diagonal)
    scale = max(np.abs(diagonal).max(), np.abs(off).max() if d > 1 else 0.0)
    if scale == 0:
        return np.eye(len(values), d)
    eps = np.finfo(float).eps
    draw = np.random.default_rng(1)
    out = np.zeros((len(values), d))
    cluster = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * scale:
            cluster = j
        near = out[cluster:j]
        x = draw.standard_normal(d)
        # Equal values are kept a little apart, as equal shifts would find one vector twice.
        shift = value - eps * scale * (j - cluster)
        for _ in range(5):
            x = _solve_shifted(diagonal, off, shift, x / np.linalg.norm(x), eps * scale)
            for _ in range(2):
                x = x - near.T @ (near @ x)
        out[j] = x / np.linalg.norm(x)
    return out


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as rows."""
    k = min(k, len(covariance))
    diagonal, off, reflections = tridiagonal(covariance)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = eigenvectors(diagonal, off, values)
    for j in range(len(reflections) - 1, -1, -1):
        v = reflections[j]
        vectors[:, j + 1 :] -= 2 * np.outer(vectors[:, j + 1 :] @ v, v)
    largest = vectors[np.arange(k), np.abs(vectors).argmax(axis=1)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)[:, None]


@dataclass
class Whitening:
    """What projecting needs; ``scales`` is NaN for components without variance."""

    n: int
    sums: np.ndarray
    means: np.ndarray
    trace: float
    values: np.ndarray
    components: np.ndarray

    @property
    def scales(self) -> np.ndarray:
        least = max(self.trace, 0.0) * len(self.means) * np.finfo(float).eps
        return np.where(self.values > least, 1 / np.sqrt(np.where(self.values > least, self.values, 1.0)), np.nan)

    @property
    def explained(self) -> np.ndarray:
        return np.where(np.isnan(self.scales), 0.0, self.values / (self.trace or 1.0))


def fit(vectors: DataFrame, k: int = 8, vector: str = "x") -> Whitening | None:
    """Fit on all vectors (arrays of one length, of long or double); None without rows."""
    if dict(vectors.dtypes)[vector] not in ("array<bigint>", "array<double>"):
        raise ValueError(f"{vector} must be an array of long or double")
    found = moments(vectors, vector)
    if found is None:
        return None
    covariance = found.products / found.n
    covariance = (covariance + covariance.T) / 2
    values, components = leading_components(covariance, k)
    return Whitening(found.n, found.sums, found.means, float(np.trace(covariance)), values, components)


def project(vectors: DataFrame, model: Whitening, vector: str = "x", out: str = "whitened") -> DataFrame:
    """Append the projections on all components, an array with null for those without variance."""
    # The mean in two parts, exact sums divided, so that nothing is lost before the subtraction.
    whole = model.sums.dtype.kind == "i"
    base = model.sums // model.n if whole else np.floor(model.means)
    rest = (model.sums - base * model.n) / model.n if whole else model.means - base
    scaled, flat = model.components * model.scales[:, None], np.isnan(model.scales)
    vectors = vectors.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(column(batch, vector))
            got = ((x - base) - rest) @ scaled.T
            cells = pa.array(got.ravel(), mask=np.broadcast_to(flat, got.shape).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * got.shape[1], pa.int32()), cells)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, out])

    return vectors.mapInArrow(run, vectors.withColumn(out, F.lit(None).cast("array<double>")).schema)


def identity_error(projected: DataFrame, model: Whitening, whitened: str = "whitened") -> float:
    """The largest entry, in size, of the projections' covariance minus the identity, from all rows.

    Components without variance are left out; 0 if none is left.
    """
    if np.isnan(model.scales).all():
        return 0.0
    live = projected.select(F.filter(whitened, lambda v: v.isNotNull()).alias(whitened))
    found = moments(live, whitened)
    return float(np.abs(found.products / found.n - np.eye(len(found.products))).max())


@register("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantise(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select("vec_id", "x")
    model = fit(rows)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], schema)
    projected = project(rows, model)
    error = identity_error(projected, model)
    # In whole numbers of 64 bits; Spark raises an error where they do not suffice.
    sums = F.lit(model.sums.tolist()).cast("array<long>")
    apart = F.zip_with("x", sums, lambda x, s: F.lit(model.n).cast("long") * x - s)
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda total, t: total + t * t)
    return (
        projected.select("vec_id", deviation.alias("deviation"), "whitened")
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(F.lit(model.explained.tolist()).cast("array<double>"), F.col("at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
