"""Embedding whitening by a spectral divide-and-conquer with QDWH.

1. Vectors become whole numbers; their number and sums are exact.
2. Every task adds up the products of its centred vectors; the matrices are added
   row by row in Spark, and one d x d covariance reaches the driver.
3. There it is split (``eigenpairs``): the polar factor U of the covariance minus
   a shift, from the QR-based dynamically weighted Halley iteration, gives the
   projector (U + I) / 2 onto the directions with eigenvalues above the shift; a
   pivoted basis of its range and of the rest cuts the space in two, and each part
   is split in the same way until it has one direction.  Parts below the wanted
   components are left alone.
4. The mean and the components go out by broadcast (their size is that of
   ``count`` vectors) and every vector is whitened; one more pass measures how far
   the covariance of the whitened vectors is from the identity.

Defined cases: a null vector, and one with a null or non-finite entry, takes no
part; neither does one whose length is not the commonest (of equally common ones
the larger) or 0; entries are cut at +-2**52 before they become whole numbers; a
direction without variance (eigenvalue at most 1e-12 of the trace) cannot be
whitened and is no component, so one vector, or equal ones, give no rows; repeated
rows and null ids are kept; a deviation that no long holds is null; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from closeledger.llm.common import arrow_map, partitions, read_table

SCALE, OFFSET = 1024.0, 100_000
#: Whole numbers beyond this are cut, so that sums of parts stay exact.
MOST = 1 << 62
#: Share of the trace up to which an eigenvalue counts as none.
FLAT = 1e-12
#: Numbers of a model that may be broadcast.
MODEL_NUMBERS = 8 << 20

EPS = float(np.finfo(float).eps)


def polar(b: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH."""
    x = b / np.linalg.norm(b, 1)
    try:  # for a symmetric matrix the 1-norm bounds the 2-norm of the inverse
        low = 1.0 / np.linalg.norm(np.linalg.inv(x), 1)
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS), 1.0)
    eye = np.eye(len(b))
    for _ in range(30):
        d = np.cbrt(4.0 * (1.0 - low**2) / low**4)
        root = np.sqrt(1.0 + d)
        a = root + 0.5 * np.sqrt(8.0 - 4.0 * d + 8.0 * (2.0 - low**2) / (low**2 * root))
        weight = (a - 1.0) ** 2 / 4.0
        c = a + weight - 1.0
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        new = (weight / c) * x + (a - weight / c) / np.sqrt(c) * (q[: len(b)] @ q[len(b) :].T)
        low = min(low * (a + weight * low**2) / (1.0 + c * low**2), 1.0)
        moved = np.linalg.norm(new - x)
        x = (new + new.T) / 2.0
        if abs(low - 1.0) < 10 * EPS and moved < (10 * EPS) ** (1 / 3):
            break
    return x


def _bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of the rest."""
    left, rows, pivots = np.diag(projector).copy(), np.zeros((rank, len(projector))), []
    for i in range(rank):  # pivots of a Cholesky factorisation choose the columns
        at = int(np.argmax(left))
        pivots.append(at)
        rows[i] = (projector[at] - rows[:i, at] @ rows[:i]) / np.sqrt(max(left[at], EPS))
        left -= rows[i] ** 2
        left[pivots] = -np.inf
    q, _ = np.linalg.qr(projector[:, pivots], mode="complete")
    return q[:, :rank], q[:, rank:]


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift inside the
    spectrum; None where all eigenvalues are equal."""
    n, mean = len(a), float(np.trace(a)) / len(a)
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    if spread <= 8 * EPS * n * max(np.linalg.norm(a, 1), np.finfo(float).tiny):
        return None
    # the mean lies strictly inside; where it meets an eigenvalue, a step aside does not
    for shift in (float(np.median(np.diag(a))), *(mean + t * spread / n for t in (0.0, 0.37, -0.41, 0.83, -0.89))):
        u = polar(a - shift * np.eye(n))
        rank = (n + float(np.trace(u))) / 2.0
        if 0.5 < rank < n - 0.5 and abs(rank - round(rank)) < 1e-6:
            return _bases((u + np.eye(n)) / 2.0, round(rank))
    raise ArithmeticError("no shift splits the spectrum")


def eigenpairs(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and
    their unit eigenvectors as columns."""
    a = (a + a.T) / 2.0
    values, vectors, parts = [], [], [np.eye(len(a))]
    while parts and len(values) < count:
        basis = parts.pop()
        inner = basis.T @ a @ basis
        halves = split((inner + inner.T) / 2.0) if len(inner) > 1 else None
        if halves is None:
            vectors += list(basis.T)
            values += list(np.diag(inner))
        else:
            parts += [basis @ halves[1], basis @ halves[0]]
    order = np.argsort(-np.array(values), kind="stable")[:count]
    return np.array(values)[order], np.array(vectors).reshape(-1, len(a))[order].T


def usable(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows with a whole vector of the commonest length, and that length."""
    v = F.col(vector)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = rows.where(v.isNotNull() & (F.size(v) > 0) & ~bad)
    top = rows.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = int(top["d"]) if top else 0
    return rows.where(F.size(v) == d), d


def whole_numbers(batch: pa.RecordBatch, column: str, d: int) -> np.ndarray:
    """The vectors of a batch as rows of longs."""
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return np.floor(SCALE * np.clip(values, -(2.0**52), 2.0**52)).astype(np.int64) + OFFSET


def added(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """Sum of a ``size`` x ``size`` matrix over all batches; every task sends
    its rows to be added in Spark, so that one matrix reaches the driver."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                total = part(batch) + (0.0 if total is None else total)
        if total is not None:
            yield _matrix_rows({i: row for i, row in enumerate(total)})

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            numbers = batch.column("numbers").flatten().to_numpy().reshape(-1, size)
            for i, row in zip(batch.column("i").to_pylist(), numbers, strict=True):
                total[i] = total.get(i, 0.0) + row
        if total:
            yield _matrix_rows(total)

    schema = "i int, numbers array<double>"
    parts = arrow_map(rows, of_task, schema).repartition(min(size, partitions(rows.sparkSession)), "i")
    out = np.zeros((size, size))
    for row in arrow_map(parts, of_rows, schema).collect():
        out[row["i"]] = row["numbers"]
    return out


def _matrix_rows(rows: dict[int, np.ndarray]) -> pa.RecordBatch:
    numbers = pa.array([r.tolist() for r in rows.values()], pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), numbers], names=["i", "numbers"])


def sums(rows: DataFrame, vector: str, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their whole numbers."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = whole_numbers(batch, vector, d)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"])

    parts = arrow_map(rows.select(vector), of_task, "i long, n long, high long, low long")
    total = parts.groupBy("i").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "low")]).orderBy("i").collect()
    return (int(total[0]["n"]) if total else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in total]


@dataclass
class Whitener:
    """Mean in two parts, and components scaled to unit variance."""

    n: int
    sums: list[int]
    whole: np.ndarray
    rest: np.ndarray
    scaled: np.ndarray | None = None

    @staticmethod
    def of(n: int, totals: list[int]) -> Whitener:
        whole = [s // n for s in totals]
        return Whitener(n, totals, np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(totals, whole, strict=True)]))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.scaled

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum)**2, exact."""
        away = x - self.whole
        extra = [s - self.n * int(w) for s, w in zip(self.sums, self.whole, strict=True)]
        top = self.n * (int(np.abs(away).max(initial=0)) + 1)
        if top * top * x.shape[1] < 1 << 63:
            return ((self.n * away - np.array(extra, np.int64)) ** 2).sum(axis=1).tolist()
        exact = (((self.n * away.astype(object)) - np.array(extra, object)) ** 2).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in exact]


def _with_one(z: np.ndarray) -> np.ndarray:
    z = np.hstack([z, np.ones((len(z), 1))])
    return z.T @ z


def _covariance(products: np.ndarray) -> np.ndarray:
    n, mean = products[-1, -1], products[-1, :-1] / products[-1, -1]
    return products[:-1, :-1] / n - np.outer(mean, mean)


def whiten(rows: DataFrame, key: str, vector: str, count: int = 8) -> DataFrame:
    """One row per vector and component: key, component, n, deviation,
    whitened, explained, identity_error."""
    spark = rows.sparkSession
    rows, d = usable(rows.select(key, vector), vector)
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = [IntegerType(), LongType(), LongType(), DoubleType(), DoubleType(), DoubleType()]
    schema = StructType([rows.schema[key], *[StructField(c, t) for c, t in zip(names, kinds, strict=True)]])
    n, totals = sums(rows, vector, d) if d else (0, [])
    if not n:
        return spark.createDataFrame([], schema)
    model = Whitener.of(n, totals)
    plain = spark.sparkContext.broadcast(model)
    covariance = _covariance(added(rows.select(vector), lambda b: _with_one(plain.value.centred(whole_numbers(b, vector, d))), d + 1))
    values, vectors = eigenpairs(covariance, count)
    trace = float(np.trace(covariance))
    vectors, values = vectors[:, values > FLAT * trace], values[values > FLAT * trace]
    if not len(values):
        return spark.createDataFrame([], schema)
    model.scaled = vectors / np.sqrt(values)
    if model.scaled.size + 3 * d > MODEL_NUMBERS:
        raise ValueError(f"{d} dimensions make a model too large to broadcast")
    shared = spark.sparkContext.broadcast(model)
    white = _covariance(added(rows.select(vector), lambda b: _with_one(shared.value.whitened(whole_numbers(b, vector, d))), len(values) + 1))
    error, explained = float(np.abs(white - np.eye(len(values))).max()), values / trace

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for batch in batches:
            x = whole_numbers(batch, vector, d)
            at = np.repeat(np.arange(len(x)), k)
            deviations = pa.array(shared.value.deviations(x), pa.int64())
            columns = [
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(at), n)),
                deviations.take(pa.array(at)),
                pa.array(shared.value.whitened(x).reshape(-1)),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(at), error)),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(at)), *columns], names=[key, *names])

    return arrow_map(rows, write, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight components of all embeddings."""
    return whiten(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 8)
