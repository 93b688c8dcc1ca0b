"""Whitening of embeddings along the leading eigenvectors of their covariance.

A component is taken as the integer ``floor(1024 c) + 100000``. Sums and products are
then exact integers: every task adds up those of its rows, Spark adds up the tasks', and
the covariance is one exact fraction for each pair of dimensions, whatever the order of
the rows. What reaches the driver is as large as the square of a vector's length. Its
leading eigenpairs come from ``spectrum``; they go back to the tasks, which project each
row. The covariance of the projected rows is measured in one more pass.

Inputs: a null vector, an empty one, and one with null or non-finite components take no
part, nor does one with a component of 2 ** 40 or more, which would not be exact. If
vectors differ in length, those of the commonest length (of several, the longest) take
part. Repeated rows count and are returned each; a null ``vec_id`` is carried along. A
component whose variance is below ``LEAST`` of the first's cannot be told from rounding:
its ``whitened`` is null and ``identity_error`` leaves it out; ``explained`` is null if
all vectors are equal. ``deviation`` is null where it does not fit a long. An empty table
gives no rows. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from andenlake.llm.shared import stored, to_arrow
from andenlake.llm.spectrum import leading

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LIMIT = float(1 << 40)
LEAST = 1e-11
#: Rows multiplied at once, and the entries up to which that is exact in doubles.
ROWS = 1 << 12
EXACT = 1 << 20

WHITENED = ("vec_id long, component int, n long, deviation long, whitened double, "
            "explained double, identity_error double")


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v: the vectors that take part, whatever their length."""
    fits = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LIMIT))
    return vectors.filter(fits & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("v"))


def integers(column: pa.Array, length: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
    return np.floor(SCALE * values).astype("i8") + SHIFT


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    if len(x) and int(np.abs(x).max()) < (1 << 62) // len(x):
        return x.sum(0).astype(object)
    return x.astype(object).sum(0)


def products(y: np.ndarray) -> np.ndarray:
    """Sums of the products of all pairs of columns, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for k in range(0, len(y), ROWS):
        part = y[k:k + ROWS]
        if int(np.abs(part).max()) < EXACT:  # every sum stays below 2 ** 53
            real = part.astype("f8")
            total += (real.T @ real).astype("i8").astype(object)
        else:
            whole = part.astype(object)
            total += whole.T @ whole
    return total


def sums(rows: DataFrame) -> DataFrame:
    """size, i, n, s: for each length of vectors the number of rows and the sum of dimension i."""
    schema = to_arrow(rows.sparkSession, "size int, i int, n long, s decimal(38,0)")

    def work(batches):
        found: dict = {}
        for batch in batches:
            sizes = batch["v"].value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                x = integers(batch["v"].filter(pa.array(sizes == size)), size)
                n, s = found.get(size, (0, 0))
                found[size] = n + len(x), s + exact_sum(x)
        for size, (n, s) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()),
                 pa.array([n] * size), pa.array(s.tolist(), pa.decimal128(38, 0))], schema=schema)

    return rows.mapInArrow(work, "size int, i int, n long, s decimal(38,0)").groupBy(
        "size", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))


@dataclass(frozen=True)
class Space:
    """The fit list: number of vectors, sum of each dimension, and a whole number near its mean."""

    n: int
    total: np.ndarray
    centre: np.ndarray

    @property
    def left(self) -> np.ndarray:
        """Sum of what ``centred`` gives."""
        return self.total - self.n * self.centre.astype(object)

    def centred(self, column: pa.Array) -> np.ndarray:
        return integers(column, len(self.centre)) - self.centre

    def from_mean(self, y: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        if self.n * (int(np.abs(y).max(initial=0)) + 1) < 1 << 62:
            return self.n * y - self.left.astype("i8")
        return self.n * y.astype(object) - self.left


def deviations(apart: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, null where it is no long."""
    most = int(np.abs(apart).max(initial=0))
    if most ** 2 * max(1, apart.shape[1]) < 1 << 63:
        return (apart * apart).sum(1).tolist()
    whole = (apart.astype(object) ** 2).sum(1).tolist()
    return [v if v < 1 << 63 else None for v in whole]


def covariance(rows: DataFrame, space: Space) -> np.ndarray:
    """Every entry is the exact fraction, rounded once."""
    layout = "i int, j int, g decimal(38,0)"
    schema, size = to_arrow(rows.sparkSession, layout), len(space.centre)
    i, j = np.triu_indices(size)

    def work(batches):
        total = None
        for batch in batches:
            part = products(space.centred(batch["v"]))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array(total[i, j].tolist(), pa.decimal128(38, 0))], schema=schema)

    summed = rows.mapInArrow(work, layout).groupBy("i", "j").agg(F.sum("g").alias("g"))
    matrix, left, n = np.zeros((size, size)), space.left.tolist(), space.n
    for a, b, g in summed.collect():  # the square of a vector's length
        matrix[a, b] = matrix[b, a] = (n * int(g) - left[a] * left[b]) / (n * n)
    return matrix


def identity_error(rows: DataFrame, space: Space, project: np.ndarray) -> float:
    """Largest entry of the projected rows' covariance minus the identity."""
    layout = "k int, l int, value double"
    schema, m = to_arrow(rows.sparkSession, layout), project.shape[1]
    k, l = np.triu_indices(m)

    def work(batches):
        total, mean = np.zeros((m, m)), np.zeros(m)
        for batch in batches:
            w = projected(space.from_mean(space.centred(batch["v"])), space.n, project)
            total, mean = total + w.T @ w, mean + w.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([k, np.arange(m)]), pa.int32()),
             pa.array(np.concatenate([l, np.full(m, -1)]), pa.int32()),
             pa.array(np.concatenate([total[k, l], mean]))], schema=schema)

    found = {(r.k, r.l): r.value / space.n for r in rows.mapInArrow(work, layout).groupBy(
        "k", "l").agg(F.sum("value").alias("value")).collect()}
    return max((abs(found[a, b] - found[a, -1] * found[b, -1] - (a == b))
                for a, b in zip(k.tolist(), l.tolist())), default=0.0)


def projected(apart: np.ndarray, n: int, project: np.ndarray) -> np.ndarray:
    return (apart / n).astype("f8") @ project


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector that takes part and each component."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    by_size = stored(sums(rows), "vector-sums")
    first = by_size.orderBy(F.desc("n"), F.desc("size")).first()
    if first is None:
        return spark.createDataFrame([], WHITENED)
    size, n = first["size"], first["n"]
    total = np.zeros(size, object)
    for r in by_size.filter(F.col("size") == size).collect():  # a vector's length
        total[r.i] = int(r.s)
    centre = np.array([(2 * s + n) // (2 * n) for s in total], "i8")
    space = Space(n, total, centre)
    rows = rows.filter(F.size("v") == size)

    matrix = covariance(rows, space)
    values, axes = leading(matrix, components)
    varies = values > LEAST * max(values[0], 0)
    project = axes[:, varies] / np.sqrt(values[varies])
    error = identity_error(rows, space, project)
    trace = float(np.trace(matrix))
    explained = values.clip(0) / trace if trace > 0 else None
    schema, m = to_arrow(spark, WHITENED), len(values)

    def work(batches):
        for batch in batches:
            apart = space.from_mean(space.centred(batch["v"]))
            white = np.full((len(apart), m), np.nan)
            white[:, varies] = projected(apart, space.n, project)
            each = np.repeat(np.arange(len(apart)), m)
            flat = white.ravel()
            yield pa.RecordBatch.from_arrays([
                batch["vec_id"].take(pa.array(each)),
                pa.array(np.tile(np.arange(1, m + 1), len(apart)), pa.int32()),
                pa.array(np.full(len(each), n)),
                pa.array(deviations(apart), pa.int64()).take(pa.array(each)),
                pa.array(flat, mask=np.isnan(flat)),
                pa.nulls(len(each), pa.float64()) if explained is None
                else pa.array(np.tile(explained, len(apart))),
                pa.array(np.full(len(each), error))], schema=schema)

    return rows.mapInArrow(work, WHITENED)
