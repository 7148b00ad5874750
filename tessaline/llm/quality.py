"""Quality by compression: the difference that a dictionary of good text makes against one of bad text.

Zstandard dictionaries are trained on good and on bad labelled texts. A text is compressed with either; the difference of
the two sizes over the size without a dictionary is positive where the good one helps more. The difference and the plain
compression ratio (junk packs tightly) are calibrated to a probability by logistic regression on labelled texts that no
dictionary has seen.

Whole texts are compressed. The sample is bounded by `max_rows` labelled rows of at most `max_text` bytes; the dictionaries
by `dict_bytes`. They go to executors inside the task, some 200 kB.

Defined results: null and empty texts get the score of the constant alone, which the calibration learns from a text with
differences zero; with labels of one kind only, every score is the smoothed share of that kind; repeated rows get a row
each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, small_batches
from .labelled import logistic, sample, sigmoid


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    weights: np.ndarray
    level: int = 3

    def packers(self) -> tuple:
        made = [zstandard.ZstdCompressor(level=self.level, write_content_size=False)]
        for data in (self.good, self.bad):
            own = zstandard.ZstdCompressionDict(data)
            own.precompute_compress(level=self.level)
            made.append(zstandard.ZstdCompressor(level=self.level, dict_data=own, write_content_size=False, write_dict_id=False))
        return tuple(made)

    def features(self, texts: list[bytes], packers: tuple) -> np.ndarray:
        """Normalised size difference; how far the text packs; the difference and the constant for short texts apart."""
        out = np.zeros((len(texts), 5))
        for i, text in enumerate(texts):
            if text:
                plain, good, bad = (len(p.compress(text)) for p in packers)
                short = 1 / (1 + len(text) / 500)
                packs = min(1.0, plain / len(text))
                out[i] = 10 * (bad - good) / plain, packs, (packs - 0.5) ** 2 * 10, 10 * (bad - good) / plain * short, short
        return out

    def score(self, texts: list[bytes], packers: tuple) -> np.ndarray:
        return sigmoid(self.features(texts, packers) @ self.weights[:-1] + self.weights[-1])


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """Trained on pieces of the texts; raw content where there is too little to train on."""
    pieces = [t[a : a + 2048] for t in texts for a in range(0, len(t), 2048)]
    total = sum(map(len, pieces))
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), pieces, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return (b"\n".join(pieces) or b" ")[-size:].ljust(8, b" ")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 12_000, max_text: int = 16_384, dict_bytes: int = 98_304, text_col: str = "text", id_col: str = "doc_id") -> CompressionModel:
    """Half of the sample makes the dictionaries, half the calibration."""
    texts, y, part = sample(docs, labels, label, max_rows, max_text, text_col, id_col)
    first = part < 5
    kinds = [[t for t, v, f in zip(texts, y, first, strict=True) if f and v == k] for k in (1, 0)]
    model = CompressionModel(*(_dictionary(k, dict_bytes) for k in kinds), np.zeros(6))
    rest = np.flatnonzero(~first)
    if len(set(y[rest].tolist())) < 2 or not all(kinds):
        share = (y.sum() + 0.5) / (len(y) + 1)
        model.weights[-1] = np.log(share / (1 - share))
        return model
    x = model.features([texts[i] for i in rest], model.packers())
    model.weights = logistic(x, y[rest], ridge=0.1)
    return model


def score(docs: DataFrame, model: CompressionModel, threshold: float = 0.7, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) of each row."""
    small_batches(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = model.packers()
        for batch in batches:
            value = model.score([t or b"" for t in batch.column(1).to_pylist()], packers)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), pa.array((value >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted): train outside the held-out fold, score everything."""
    scored = score(docs, train(docs, labels, **options), threshold)
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")
