"""Embedding whitening: principal components of a distributed covariance, refined to double precision.

Vectors are put on a grid, x = floor(256 * c), so that all sums over them are sums of whole numbers
and come out the same in any order, partition or retry. The fit list is each distinct x once. One
pass gives its size n and sums S, a second the products of x - round(S/n): every task multiplies
blocks whose products double precision holds exactly and sends one matrix, which Spark adds up as
decimals. What reaches the driver has the size of the covariance, width times width.

The eigenvectors start in single precision. Ogita-Aishima iterations, which are matrix products in
higher precision (double first, extended after), correct them: with R = I - X'X and S = X'VX, each pair
of columns is turned by (s_ij + e_j r_ij) / (e_j - e_i), which doubles the right digits. Pairs whose
eigenvalues lie closer than the error allows to tell are only kept orthogonal there; such a cluster is
solved on its own, as the small matrix of V minus the cluster's mean eigenvalue in the cluster's
columns, whose own scale then separates them in the next iteration.

Rows: one whose vector is null, or has a null, NaN or infinite entry, is dropped, and so is one
shorter than the longest vector, whose missing entries count as null. Entries beyond 2**45 count as
infinite. Repeated rows are in the result as often as they occur and once in the fit. A null id stays.
A component with no variance (below 2**-52 of the trace) cannot be whitened and has no row: equal
vectors, a single one and an empty table give an empty result. A deviation beyond a bigint is null.
Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.llm.common import tidy
from flowlab.sources.storage import durable

GRID = 256
LARGEST_ENTRY = float(2**45)
COMPONENTS = 4
#: Digits (base 2**20) that whole numbers are cut into, and rows whose products are added in double
#: precision: 20 + 20 + 13 bits are exact there.
LIMB_BITS = 20
BLOCK_ROWS = 1 << 13
LEAST_SHARE = 2.0**-52
MOST_ITERATIONS = 6
WHOLE = pa.decimal128(38, 0)


def on_grid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows that have all entries; the longest of these may be longer than others."""
    entry = F.col(vector_col).cast("array<double>")
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST_ENTRY))
    x = F.transform(entry, lambda c: F.floor(c * GRID).cast("bigint"))
    return vectors.filter(F.col(vector_col).isNotNull() & ~bad).select(F.col(id_col).alias("id"), x.alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        rows = matrix(batch.column("x"), width)
        for start in range(0, len(rows), BLOCK_ROWS):
            yield rows[start : start + BLOCK_ROWS]


def gram(block: np.ndarray) -> np.ndarray:
    """block' block as Python integers, exact for all 64-bit entries and up to BLOCK_ROWS rows."""
    limbs, rest = [], block
    while np.abs(rest).max(initial=0) >= 1 << LIMB_BITS:
        limbs.append(rest & ((1 << LIMB_BITS) - 1))
        rest = rest >> LIMB_BITS
    limbs = [x.astype(np.float64) for x in (*limbs, rest)]
    total = np.zeros((block.shape[1],) * 2, object)
    for p, one in enumerate(limbs):
        for q, other in enumerate(limbs):
            total += (one.T @ other).astype(np.int64).astype(object) * (1 << LIMB_BITS * (p + q))
    return total


def column_sums(block: np.ndarray) -> np.ndarray:
    """Sums of rows as Python integers: upper and lower halves apart, so that neither overflows."""
    upper, lower = block >> 32, block & 0xFFFFFFFF
    return upper.sum(axis=0).astype(object) * (1 << 32) + lower.sum(axis=0).astype(object)


def cells(values: np.ndarray) -> pa.Array:
    return pa.array([Decimal(v) for v in values.tolist()], WHOLE)


def sums(fit: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """How many vectors there are, and their sums per dimension."""

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(width, object)
        for block in blocks(batches, width):
            count, total = count + len(block), total + column_sums(block)
        if count:
            at = pa.array(range(width), pa.int32())
            yield pa.record_batch([at, pa.array([count] * width, pa.int64()), cells(total)], ["i", "rows", "value"])

    parts = fit.mapInArrow(add, "i int, rows bigint, value decimal(38,0)")
    found = parts.groupBy("i").agg(F.sum("rows").alias("rows"), F.sum("value").alias("value")).collect()  # width rows
    total = np.zeros(width, object)
    for row in found:
        total[row.i] = int(row.value)
    return (found[0].rows if found else 0), total


def products(fit: DataFrame, width: int, centre: np.ndarray) -> np.ndarray:
    """Sum of (x - centre)(x - centre)' as Python integers; ``centre`` is whole."""
    shift = centre.astype(np.int64)

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for block in blocks(batches, width):
            total += gram(block - shift)
        for i in range(width if total.any() else 0):
            across = pa.array(range(i, width), pa.int32())
            yield pa.record_batch([pa.array([i] * len(across), pa.int32()), across, cells(total[i, i:])], ["i", "j", "value"])

    parts = fit.mapInArrow(add, "i int, j int, value decimal(38,0)")
    total = np.zeros((width, width), object)
    for row in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():  # width x width / 2
        total[row.i, row.j] = total[row.j, row.i] = int(row.value)
    return total


def extended(whole: np.ndarray, divisor: int) -> np.ndarray:
    """Python integers over a common divisor in extended precision."""
    texts = [np.longdouble(str(v)) for v in whole.ravel().tolist()]
    return np.array(texts, np.longdouble).reshape(whole.shape) / np.longdouble(str(divisor))


def clusters(values: np.ndarray, apart: np.ndarray) -> list[np.ndarray]:
    """Places of eigenvalues that are joined by gaps too small to tell, two or more each."""
    order = np.argsort(values)
    cuts = [k + 1 for k, (a, b) in enumerate(zip(order, order[1:], strict=False)) if apart[a, b]]
    return [part for part in np.split(order, cuts) if len(part) > 1]


def refine(exact: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of a symmetric matrix in extended precision, from approximate
    eigenvectors: iterations in double precision, then in extended precision.

    An iteration squares the error, so one that turns no pair by more than the square root of what its
    precision holds is the last. Equal eigenvalues are never apart and use up all iterations. What
    rounding turns close pairs by is undone at the end, where columns are only made orthogonal.
    """
    norm, x = np.sqrt((exact * exact).sum()), start
    for kind in (np.float64, np.longdouble):
        x, work = x.astype(kind), exact.astype(kind)
        for _ in range(MOST_ITERATIONS):
            r = np.eye(len(x), dtype=kind) - x.T @ x
            s = x.T @ (work @ x)
            values = np.diag(s) / (1 - np.diag(r))
            off = s - np.diag(np.diag(s))
            gap = values[None, :] - values[:, None]
            unsure = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
            apart = np.abs(gap) > unsure
            turn = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
            x, close = x + x @ turn, clusters(values, apart)
            for places in close:
                x[:, places] = solved_apart(exact, x[:, places], values[places].mean())
            if not close and np.abs(turn).max() < np.sqrt(np.finfo(kind).eps):
                break
    for _ in range(2):
        x = x + x @ (np.eye(len(x), dtype=x.dtype) - x.T @ x) / 2
    return np.diag(x.T @ (exact @ x)), x


def solved_apart(exact: np.ndarray, columns: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """The columns of a cluster turned so that they are eigenvectors of what is left when the cluster's
    mean eigenvalue is taken off: there the small differences are not small any more."""
    wide = columns.astype(np.longdouble)
    small = wide.T @ (exact @ wide - np.longdouble(middle) * wide)
    small = (small + small.T) / 2
    scale = np.abs(small).max()
    if scale == 0:
        return columns
    turn = np.linalg.eigh((small / scale).astype(np.float64))[1][:, ::-1]
    return (wide @ turn.astype(np.longdouble)).astype(columns.dtype)


@dataclass(frozen=True)
class Whitening:
    """n and sums of the fit list, and per component its unit vector (a row), variance and share."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    shares: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, block: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit numbers where they suffice, Python integers elsewhere."""
        most = self.n * int(np.abs(block).max(initial=0)) + max(map(abs, self.sums.tolist()), default=0)
        if most < 2**53:
            return block * np.int64(self.n) - self.sums.astype(np.int64)
        return block.astype(object) * self.n - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) @ self.directions.T) / (self.n * np.sqrt(self.variances))

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        if centred.dtype == np.int64 and self.width * int(np.abs(centred).max(initial=0)) ** 2 < 2**63:
            return (centred * centred).sum(axis=1).tolist()
        totals = (sum(v * v for v in row) for row in centred.astype(object).tolist())
        return [t if t < 2**63 else None for t in totals]


def fit_whitening(fit: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """The first components of a stored table of distinct grid vectors (x); None where it is empty."""
    width = fit.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None
    n, total = sums(fit, width)
    centre = np.array([(2 * s + n) // (2 * n) for s in total.tolist()], object)
    rest = total - n * centre
    covariance = extended(n * products(fit, width, centre) - np.outer(rest, rest), n * n)
    trace = np.trace(covariance)
    if trace == 0:
        return Whitening(n, total, np.zeros((0, width)), np.zeros(0), np.zeros(0))
    scaled = covariance / trace
    values, vectors = refine(scaled, np.linalg.eigh(scaled.astype(np.float32))[1])
    first = [k for k in np.argsort(-values, kind="stable")[:most] if values[k] > LEAST_SHARE]
    directions = vectors[:, first].T
    directions = directions / np.sqrt((directions * directions).sum(axis=1, keepdims=True))
    largest = np.abs(directions).argmax(axis=1)
    directions = directions * np.sign(directions[np.arange(len(first)), largest])[:, None]
    return Whitening(
        n, total, directions.astype(np.float64), (values[first] * trace).astype(np.float64), values[first].astype(np.float64)
    )


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    size = len(model.variances)

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for block in blocks(batches, model.width):
            white = model.whitened(model.centred(block))
            total += white.T @ white
        i, j = np.indices((size, size))
        yield pa.record_batch([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "value"])

    parts = fit.mapInArrow(add, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    aim = F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)
    return parts.agg(F.max(F.abs(F.col("value") / model.n - aim))).first()[0]


def whiten(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per row and component."""
    rows = on_grid(vectors, id_col, vector_col)
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.filter(F.size("x") == width)
    fit = durable(rows.select("x").distinct(), "fit")
    model = fit_whitening(fit, most)
    kind = rows.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if model is None or not len(model.variances):
        return vectors.sparkSession.createDataFrame([], schema)
    size, error = len(model.variances), identity_error(fit, model)

    @tidy
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                centred = model.centred(matrix(part.column("x"), model.width))
                each = np.repeat(np.arange(part.num_rows), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), part.num_rows)),
                        pa.array(np.full(len(each), model.n)),
                        pa.array(model.deviations(centred), pa.int64()).take(pa.array(each)),
                        pa.array(model.whitened(centred).ravel()),
                        pa.array(np.tile(model.shares, part.num_rows)),
                        pa.array(np.full(len(each), error)),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(project, schema)
