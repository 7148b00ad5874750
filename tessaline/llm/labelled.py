"""Bounded labelled samples for the classifiers, the only rows that reach the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int, text_col: str = "text", id_col: str = "doc_id", held_out: tuple[int, int] = (4, 2)) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(texts, labels 0/1, part 0..9) of at most max_rows labelled rows outside the held-out fold, in the order of a hash.

    Texts over max_bytes are left out of the sample (they are scored all the same). Equal (id, label) rows count once; ids
    with both labels are left out. part is another hash, to divide the sample.
    """
    marked = labels.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__y")).filter("__y IN (0, 1) AND __id IS NOT NULL")
    marked = marked.groupBy("__id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__z")).filter("__y = __z")
    marked = marked.filter(fold(F.col("__id"), held_out[0]) != held_out[1])
    # Which ids, before any text moves: labels are narrow. A share by hash, a little below the bound, instead of a top-k in one task.
    marked = marked.withColumn("__h", F.xxhash64("__id", F.lit(17)))
    total = marked.count()
    part = min(1.0, 0.95 * max_rows / total) if total > max_rows else 1.0
    chosen = marked.filter(F.pmod("__h", F.lit(1 << 32)) < F.lit(int(part * (1 << 32))))
    rows = docs.select(F.col(id_col).alias("__d"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__t")).filter(F.octet_length("__t") <= max_bytes)
    got = rows.join(F.broadcast(chosen), rows["__d"] == chosen["__id"]).select("__t", "__y", F.pmod(F.xxhash64("__id", F.lit(29)), F.lit(10)).alias("part"), "__h").toArrow()
    order = sorted(range(got.num_rows), key=lambda i, h=got["__h"].to_pylist(), t=got["__t"].to_pylist(): (h[i], t[i]))
    got = got.take(pa.array(order, pa.int64())).slice(0, max_rows)
    return [bytes(t) for t in got["__t"].to_pylist()], np.array(got["__y"].to_pylist(), np.int64), np.array(got["part"].to_pylist(), np.int64)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Weights (constant last) of a logistic regression by Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
