"""Whitening of embeddings by a compensated covariance.

Entries become whole numbers far from zero, so products before centring would lose what matters. Each task centres its rows
about the exact mean (a double-double), and adds up outer products by error-free transformations: centred values are split,
column by column, into slices of 21 bits, so that the product of two slices over a block of rows is a matrix product without
any rounding; block products go into a high and a low part by two-sums. Tasks' parts are merged the same way on executors,
in two steps, by rows of the matrix. The eigen-solve reduces the matrix to tridiagonal form and divides and conquers (LAPACK's
syevd, by numpy); it is of the dimension's size, as is all that the driver holds, whatever the number of rows.

Passes: distinct vectors (a partial aggregate, so copies collapse before they meet) are written once and read for sums, for
the covariance and for the check of the whitened covariance.

Defined results: rows whose vector is null, empty or has null or non-finite entries are left out, and so are those of another
length than the most frequent (of equally frequent ones the smallest). Repeated rows stay; equal vectors count once in the
fit. Entries beyond 2**52 / 64 count as that. deviation is null beyond a long. Directions without variance (below 1e-13 of the
trace) are no components: one distinct vector, or an empty table, gives no rows. Extra columns are ignored, a null vec_id stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

COMPONENTS = 16
#: Fixed by the contract: entries are scaled, floored and moved.
SCALE, OFFSET = 64, 1_000_000
BLOCK, BITS = 1024, 21  # a sum of BLOCK products of two slices has 2 * BITS + 10 bits at most
_LEAST = 1e-13


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(s, e) with s + e = a + b exactly and s the rounded sum."""
    s = a + b
    v = s - a
    return s, (a - (s - v)) + (b - v)


def dd_add(hi: np.ndarray, lo: np.ndarray, b_hi: np.ndarray, b_lo: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two double-doubles."""
    s, e = two_sum(hi, b_hi)
    t, f = two_sum(lo, b_lo)
    s, e = two_sum(s, e + t)
    return two_sum(s, e + f)


def slices(hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
    """hi + lo, column by column, as three slices of BITS bits each; the first two and what is left are exact."""
    top = np.frexp(np.maximum(np.abs(hi).max(axis=0), 2.0**-900))[1]
    out, rest = [], hi
    for k in range(3):
        if k == 2:
            rest = rest + lo
        unit = np.ldexp(1.0, top - (k + 1) * BITS)
        part = np.rint(rest / unit) * unit
        out.append(part)
        rest = rest - part
    return out


def block_product(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of outer products of the rows of hi + lo, as a double-double; at most BLOCK rows."""
    a, b, c = slices(hi, lo)
    ab, ac, bc = a.T @ b, a.T @ c, b.T @ c
    total = (a.T @ a, np.zeros((hi.shape[1],) * 2))
    for part in (ab, ab.T, b.T @ b, ac, ac.T, bc, bc.T):
        total = dd_add(*total, part)
    return total


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """x - sums / n as double-doubles."""
    mean = [Fraction(s, n) for s in sums]
    m_hi = np.array([float(m) for m in mean])
    m_lo = np.array([float(m - Fraction(float(m))) for m in mean])
    hi, lo = two_sum(x.astype(np.float64), -m_hi)
    return two_sum(hi, lo - m_lo)


def _matrix(batch: pa.RecordBatch, column: int, dim: int) -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), dim)


def whole_numbers(entries: Column | str) -> Column:
    """Entries as long: floor(SCALE * c) + OFFSET."""
    bound = float(1 << 52)
    return F.transform(entries, lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-bound)), F.lit(bound))).cast("bigint") + F.lit(OFFSET).cast("bigint"))


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """((vec_id, x) of the rows that remain, dimension); dimension 0 where there are none."""
    c = F.col(vector_col)
    bad = F.exists(c, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    good = rows.filter(c.isNotNull() & (F.size(c) > 0) & ~bad).select(F.col(id_col).alias("vec_id"), whole_numbers(c).alias("x"))
    top = good.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if top is None:
        return good, 0
    return good.filter(F.size("x") == top["dim"]), top["dim"]


def _merged(parts: DataFrame, dim: int, fan: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Parts (task, row, hi, lo) of double-double matrices summed by row, by executors in two steps; rows of one matrix come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            hi, lo = _matrix(batch, 2, dim), _matrix(batch, 3, dim)
            for k, row in enumerate(batch.column(1).to_pylist()):
                held[row] = dd_add(*held[row], hi[k], lo[k]) if row in held else (hi[k], lo[k])
        if held:
            yield _parts(0, list(held), np.array([v[0] for v in held.values()]), np.array([v[1] for v in held.values()]))

    for keys in ((F.pmod("task", F.lit(fan)), F.col("row")), (F.col("row"),)):
        parts = parts.repartition(*keys).mapInArrow(run, _PARTS)
    hi, lo = np.zeros((dim, dim)), np.zeros((dim, dim))
    for r in parts.collect():  # dim rows of dim entries
        hi[r["row"]], lo[r["row"]] = r["hi"], r["lo"]
    return hi, lo


_PARTS = "task int, row int, hi array<double>, lo array<double>"


def _parts(task: int, rows: list[int], hi: np.ndarray, lo: np.ndarray) -> pa.RecordBatch:
    many = lambda m: pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), m.ravel())
    return pa.RecordBatch.from_arrays([pa.array([task] * len(rows), pa.int32()), pa.array(rows, pa.int32()), many(np.ascontiguousarray(hi)), many(np.ascontiguousarray(lo))], names=["task", "row", "hi", "lo"])


def _products(fit: DataFrame, dim: int, out: int, n: int, sums: list[int], turn: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sum over fit of the outer products of centred rows, or of those turned by a matrix, as a double-double."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            x = _matrix(batch, 0, dim)
            for at in range(0, len(x), BLOCK):
                hi, lo = centred(x[at : at + BLOCK], n, sums)
                if turn is not None:
                    hi, lo = hi @ turn, lo @ turn
                made = block_product(hi, lo)
                total = made if total is None else dd_add(*total, *made)
        if total is not None:
            yield _parts(TaskContext.get().partitionId(), list(range(out)), *total)

    return _merged(fit.select("x").mapInArrow(run, _PARTS), out)


def exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(n, sums by dimension) of fit's vectors, exact: whole numbers in each task, decimals across tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            x = _matrix(batch, 0, dim)
            n += len(x)
            # Halves of 31 bits keep the sums of a batch within a long.
            total = total + (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(dim)], pa.int32()), pa.array([str(v) for v in (n, *total)], pa.string())], names=["place", "total"])

    rows = fit.select("x").mapInArrow(run, "place int, total string").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    found = {r["place"]: int(r["total"]) for r in rows}  # a row for each dimension
    return found.pop(-1, 0), [found[k] for k in sorted(found)]


def components(hi: np.ndarray, lo: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues falling, unit eigenvectors as columns, trace) of the covariance; the largest entry of each vector is positive."""
    v = (hi + lo) / n
    v = (v + v.T) / 2
    trace = float(np.trace(v))
    values, vectors = np.linalg.eigh(v)  # syevd: tridiagonal form, divide and conquer
    order = np.argsort(-values, kind="stable")
    held = [k for k in order if trace > 0 and values[k] > _LEAST * trace][:most]
    vectors = vectors[:, held]
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    at = np.abs(vectors).argmax(axis=0) if len(held) else []
    return values[held], vectors * np.sign(vectors[at, range(len(held))]) if len(held) else vectors, trace


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """(n * x - sums as doubles, its squares' sum for each row, exact; None beyond a long)."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
    if most < 1 << 62:
        d = x * np.int64(n) - np.array(sums, np.int64)
        if x.shape[1] * int(np.abs(d).max(initial=0)) ** 2 < 1 << 63:
            return d.astype(np.float64), (d * d).sum(axis=1).tolist()
    d = x.astype(object) * n - np.array(sums, object)
    squares = (d * d).sum(axis=1).tolist()
    return d.astype(np.float64), [s if s < 1 << 63 else None for s in squares]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each remaining row and component."""
    spark = rows.sparkSession
    small_batches(spark, 4096)
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    good, dim = usable(rows, id_col, vector_col)
    if not dim:
        return spark.createDataFrame([], schema)
    fit = cut(good.select("x").distinct(), "whitening-fit")
    n, sums = exact_sums(fit, dim)
    values, vectors, trace = components(*_products(fit, dim, dim, n, sums), n, most)
    if not len(values):
        return spark.createDataFrame([], schema)
    turn, many = vectors / np.sqrt(values), len(values)
    hi, lo = _products(fit, dim, many, n, sums, turn)
    error = float(np.abs((hi + lo) / n - np.eye(many)).max())
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            d, squares = deviations(_matrix(batch, 1, dim), n, sums)
            white = (d / n) @ turn
            size, ids = len(d), np.repeat(np.arange(len(d)), many)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(ids)), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), size)), pa.array(np.full(size * many, n, np.int64)),
                pa.array(squares, pa.int64()).take(pa.array(ids)), pa.array(white.ravel()), pa.array(np.tile(explained, size)), pa.array(np.full(size * many, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return good.mapInArrow(run, schema)
