"""Toxicity by a convolutional text classifier, trained in numpy.

Words are hashed into an embedding table, and so are their prefixes of a few lengths, as one stem may have many endings; a
word's embedding is the sum of these. Filters of several widths run over the words of a text, each filter's largest
value over the text (rectified) is a feature, and a logistic unit on these gives the logit. Words and prefixes that fewer
than `min_docs` training texts have don't count, so that no filter learns a text by its rare words. Training is
mini-batch Adagrad with dropout of words; the gradient of a maximum goes to the place that had it.

Thresholds are calibrated by language: the language is read off the text by its common words (never off a column), and each
language's logits are shifted and scaled so that its best threshold on held-back texts meets the common one.

Inference folds each filter's weights at each place into the embedding table, so that a filter is a sum of table rows: whole
texts, all words, at a few look-ups a word.

The sample is bounded by `max_rows` labelled rows of at most `max_text` bytes; the model by its parameters.

Defined results: null and empty texts, and texts without words, have features zero and so the constant's score; texts of
fewer words than a filter is wide are padded with the embedding zero; with labels of one kind every score is the smoothed
share of it; repeated rows get a row each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, fold, small_batches, words_of
from .labelled import logistic, sample, sigmoid

#: Common words by which the language of a text is told.
COMMON = {
    "en": "the of and to in is that it for was with as be by this are from at",
    "fr": "le la les des un une et dans que qui pour sur avec par est au du elle",
    "de": "der die das und den von zu mit ist im nicht ein eine auf als auch es sich",
    "es": "el los las del y que en un una por con para se su al lo como más",
}


@dataclass
class ConvModel:
    bits: int = 16
    dim: int = 12
    prefixes: tuple[int, ...] = (3, 4, 5, 6, 7)
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    seed: int = 7
    known: np.ndarray = field(default=None, repr=False)
    table: np.ndarray = field(default=None, repr=False)
    kernels: list = field(default=None, repr=False)
    biases: list = field(default=None, repr=False)
    out: np.ndarray = field(default=None, repr=False)
    shifts: np.ndarray = field(default=None, repr=False)

    def start(self, odds: np.ndarray | None = None) -> None:
        """Random weights. The embeddings' first dimension begins at odds (log odds of each bucket), which filters begin by adding up."""
        rng = np.random.default_rng(self.seed)
        n = self.filters
        self.table = rng.normal(0, 0.15, ((1 << self.bits) + 1, self.dim)).astype(np.float32)
        if odds is not None:
            self.table[1:, 0] = 0.3 * np.clip(odds, -2, 3)
        self.table[0] = 0
        self.kernels = [rng.normal(0, 0.5 / w, (w, self.dim, n)).astype(np.float32) for w in self.widths]
        for w, k in zip(self.widths, self.kernels, strict=True):
            k[:, 0, :] = 1.0 / w
        self.biases = [np.full(n, -0.1, np.float32) for _ in self.widths]
        self.out = np.append(np.tile(np.where(np.arange(n) % 4 < 3, 0.5, -0.5), len(self.widths)), -1.0).astype(np.float32)
        self.shifts = np.tile([1.0, 0.0], (len(COMMON) + 1, 1))

    def ids(self, words: np.ndarray) -> np.ndarray:
        """Table rows of words (a column each for the word and its prefixes): 0 for padding and what is rare, else bucket + 1."""
        bucket = (words >> np.uint64(64 - self.bits)).astype(np.int64)
        return np.where(self.known[bucket] & (words != 0), bucket + 1, 0)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.zeros((0, 1 + len(self.prefixes)), np.uint64), np.zeros(1, np.int64)
        value, _, _, bounds = words_of(texts, alphanumeric=True, prefixes=self.prefixes)
        return value, bounds

    def folded(self) -> list[list[np.ndarray]]:
        return [[np.ascontiguousarray(self.table @ k[j]) for j in range(w)] for w, k in zip(self.widths, self.kernels, strict=True)]

    def features(self, ids: np.ndarray, bounds: np.ndarray, tables: list) -> np.ndarray:
        """Largest rectified value of each filter over each text: ids of all texts, text i at bounds[i]:bounds[i + 1]."""
        n = len(bounds) - 1
        out = np.zeros((n, self.filters * len(self.widths)), np.float32)
        size = np.diff(bounds)
        full = np.flatnonzero(size > 0)
        if not len(full):
            return out
        # The words after place i that still belong to its text; further ones count as padding.
        left = np.repeat(bounds[1:], size) - np.arange(bounds[0], bounds[-1])
        for k, (w, own) in enumerate(zip(self.widths, tables, strict=True)):
            value = np.zeros((len(ids), self.filters), np.float32)
            for j in range(min(w, len(ids))):
                here = np.zeros((len(ids) - j, self.filters), np.float32)
                for column in ids[j:].T:
                    here += own[j][column]
                value[: len(ids) - j] += here * (left[: len(ids) - j] > j)[:, None]
            top = np.maximum.reduceat(value, bounds[full] - bounds[0], axis=0) + self.biases[k]
            out[full, k * self.filters : (k + 1) * self.filters] = np.maximum(top, 0)
        return out

    def logit(self, features: np.ndarray) -> np.ndarray:
        """Summed row by row, so that a text's value does not depend on which others stand beside it."""
        return (features.astype(np.float64) * self.out[:-1]).sum(axis=1) + float(self.out[-1])

    def fit(self, docs: list[np.ndarray], y: np.ndarray, epochs: int = 3, batch: int = 16, rate: float = 0.05, drop: float = 0.4) -> None:
        rng = np.random.default_rng(self.seed + 1)
        n, wide = self.filters, max(self.widths)
        g_table = np.full(self.table.shape[0], 1e-2, np.float32)
        g_kernels = [np.full_like(k, 1e-2) for k in self.kernels]
        g_biases = [np.full_like(b, 1e-2) for b in self.biases]
        g_out = np.full_like(self.out, 1e-2)
        balance = np.where(y == 1, 0.5 * len(y) / max(1, (y == 1).sum()), 0.5 * len(y) / max(1, (y == 0).sum()))
        balance = np.sqrt(balance)
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // batch)):
                d_out, touched = np.zeros_like(self.out), []
                d_kernels, d_biases = [np.zeros_like(k) for k in self.kernels], [np.zeros_like(b) for b in self.biases]
                for i in at:
                    ids = docs[i]
                    if not len(ids):
                        continue
                    ids = np.where(rng.random(ids.shape) < drop, 0, ids)
                    padded = np.concatenate((ids, np.zeros((wide, ids.shape[1]), ids.dtype)))
                    rows = self.table[padded].sum(axis=1)
                    feats, places = [], []
                    for k, w in enumerate(self.widths):
                        value = rows[: len(ids)] @ self.kernels[k][0]
                        for j in range(1, w):
                            value += rows[j : j + len(ids)] @ self.kernels[k][j]
                        place = value.argmax(axis=0)
                        places.append(place)
                        feats.append(np.maximum(value[place, np.arange(n)] + self.biases[k], 0))
                    f = np.concatenate(feats)
                    err = (sigmoid(f @ self.out[:-1] + self.out[-1]) - y[i]) * balance[i] / len(at)
                    d_out[:-1] += err * f
                    d_out[-1] += err
                    back = err * self.out[:-1] * (f > 0)
                    for k, w in enumerate(self.widths):
                        for c in np.flatnonzero(back[k * n : (k + 1) * n]):
                            g = back[k * n + c]
                            p = places[k][c]
                            d_biases[k][c] += g
                            for j in range(w):
                                d_kernels[k][j, :, c] += g * rows[p + j]
                                touched += [(row, g * self.kernels[k][j, :, c]) for row in padded[p + j] if row > 0]
                for value, d, g in [(self.out, d_out, g_out), *zip(self.kernels, d_kernels, g_kernels, strict=True), *zip(self.biases, d_biases, g_biases, strict=True)]:
                    g += d * d
                    value -= rate * d / np.sqrt(g)
                for row, d in touched:
                    g_table[row] += float(d @ d)
                    self.table[row] -= rate * d / np.sqrt(g_table[row])

    def languages(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Index of the language with most common words, or the number of languages where none has two more than the next."""
        names = list(COMMON)
        value = np.zeros((len(bounds) - 1, len(names)), np.int64)
        for k, name in enumerate(names):
            own = np.unique(words_of([COMMON[name].encode()], alphanumeric=True)[0])
            hit = np.concatenate(([0], np.cumsum(own[np.minimum(np.searchsorted(own, words), len(own) - 1)] == words)))
            value[:, k] = hit[bounds[1:]] - hit[bounds[:-1]]
        order = np.sort(value, axis=1)
        return np.where(order[:, -1] > order[:, -2] + 1, value.argmax(axis=1), len(names))

    def score(self, texts: list[bytes], tables: list) -> np.ndarray:
        words, bounds = self.words(texts)
        z = self.logit(self.features(self.ids(words), bounds, tables))
        own = self.shifts[self.languages(words[:, 0], bounds)]
        return sigmoid(z * own[:, 0] + own[:, 1])


def _best_shift(z: np.ndarray, y: np.ndarray, threshold: float) -> tuple[float, float] | None:
    """(scale, shift) that puts the threshold of the best F1 at `threshold`; None for too few of either kind."""
    if (y == 1).sum() < 15 or (y == 0).sum() < 15:
        return None
    scale = max(0.2, float(logistic(z[:, None], y, ridge=0.05)[0]))
    order = np.argsort(-z)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    lo, hi = best[0], best[-1]
    mid = int((lo + hi) // 2)
    cut_at = (z[order[mid]] + z[order[min(mid + 1, len(z) - 1)]]) / 2
    return scale, float(np.log(threshold / (1 - threshold)) - scale * cut_at)


def bucket_odds(rows: list[np.ndarray], fit: np.ndarray, y: np.ndarray, size: int, min_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Which buckets at least min_docs of the texts in fit have (rows: bucket + 1, 0 for none), and their smoothed log odds of label 1."""
    seen = np.zeros((2, size + 1), np.int64)
    for i in fit:
        seen[y[i], np.unique(rows[i])] += 1
    seen = seen[:, 1:]
    ones, zeros = (y[fit] == 1).sum(), (y[fit] == 0).sum()
    odds = np.log((seen[1] + 0.5) / (ones + 1)) - np.log((seen[0] + 0.5) / (zeros + 1))
    return seen.sum(axis=0) >= min_docs, odds


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.3, max_rows: int = 6_000, max_text: int = 16_384, min_docs: int = 5, text_col: str = "text", id_col: str = "doc_id") -> ConvModel:
    """Seven tenths of the sample train the network, three tenths calibrate the thresholds."""
    texts, y, part = sample(docs, labels, label, max_rows, max_text, text_col, id_col)
    model = ConvModel()
    fit = np.flatnonzero(part < 7)
    # Text by text and in 32 bits, so that the sample's words never stand in memory as hashes all at once.
    buckets: list[np.ndarray] = []
    lang: list[np.ndarray] = []
    for run in chunks(texts, len, 1 << 19):
        words, bounds = model.words(run)
        lang.append(model.languages(words[:, 0], bounds))
        own = np.where(words != 0, (words >> np.uint64(64 - model.bits)).astype(np.int32) + 1, 0)
        buckets += [own[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    model.known, odds = bucket_odds(buckets, fit, y, 1 << model.bits, min_docs)
    model.start(odds)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        model.out[:] = 0
        model.out[-1] = np.log(share / (1 - share))
        return model
    rare = np.concatenate(([True], ~model.known))
    for own in buckets:
        own[rare[own]] = 0
    model.fit([buckets[i] for i in fit], y[fit])
    tables, z = model.folded(), []
    for run in chunks(buckets, lambda x: 40 * len(x)):
        z.append(model.logit(model.features(np.concatenate(run), np.cumsum([0, *map(len, run)]), tables)))
    z, lang = np.concatenate(z), np.concatenate(lang)
    rest = part >= 7
    common = _best_shift(z[rest], y[rest], threshold) or _best_shift(z, y, threshold) or (1.0, 0.0)
    for k in range(len(COMMON) + 1):
        own = rest & (lang == k)
        model.shifts[k] = _best_shift(z[own], y[own], threshold) or common
    return model


def score(docs: DataFrame, model: ConvModel, threshold: float = 0.3, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) of each row."""
    small_batches(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.folded()
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            value = np.concatenate([model.score(part, tables) for part in chunks(texts, len)]) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value.astype(np.float64)), pa.array((value >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def keep_clean(docs: DataFrame, model: ConvModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores below the threshold, as they are: rows pass through, so no join by id is needed."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.folded()
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(place).to_pylist()]
            if texts:
                value = np.concatenate([model.score(part, tables) for part in chunks(texts, len)])
                yield batch.filter(pa.array(value < threshold))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted): train outside the held-out fold, score everything."""
    scored = score(docs, train(docs, labels, threshold=threshold, **options), threshold)
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")
