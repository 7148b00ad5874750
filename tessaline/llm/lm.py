"""Hashed maximum-entropy language model.

Every token has a class by its form (its last bytes; the end of a text is a class of its own). Within a class, words are
leaves of a tree by frequency: at each node a word takes one of 32 branches, the more frequent words after one or two steps,
all others of the head after three. Branch 0 of a class stands for its words outside the head. The probability in context is

    P(class | context) * product over the path of P(branch | node, context) * P(word | branch 0)

where each softmax sums hashed feature weights: the class softmax those of the words one, two and three places back (the
latter two skip what is between) and of the pair of the last two; the softmaxes of the nodes those of the words one and two
back. P(word | branch 0) is the smoothed share of the word's count among the class's rest, so unseen words have a probability
of their class. A context word that is not frequent stands for its form.

Counting: tasks count the words of their rows, Spark sums. The counts of the most frequent words, at most `head_words`, go to
the tasks (a fixed bound); all other words of a text are rows of an equi-join with the whole count table. So no vocabulary is cut.
Words are known by 64-bit hashes. The tree and the weight table grow with the vocabulary that was counted, up to their bounds.

Training: one pass over all training texts. Texts are dealt by their hash to shards, whose number follows the number of tokens,
and shards to rounds, more of them the more shards there are. In a round each shard starts from the same weights, makes
mini-batch Adagrad steps on its texts, in order of their hashes, and gives back each table row's change and how often it was
touched. Sums by blocks of rows, salted first, streamed in order and not collected, give the mean change of each row by
touches, lengthened for rows of few touches. So neither the partitions of the input nor lost executors change the model. The driver holds the table only.

Scoring: tokens of many texts make one batch of sparse feature rows in numpy.

Defined results: null text is empty and has one token, its end; without training texts every count is zero; a training fold
is told by the id, null as the empty text; repeated rows count and get a row each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, fold, mix64, release, small_batches, words_of

END = np.uint64(0x5BD1E9955BD1E995)
NONE = np.uint64(0x27D4EB2F165667C5)
#: Bound of a weight: four of them and a bias at most zero stay within the exponentials of 32-bit floats.
WEIGHT = 18.0
#: Branches of a node; of the first 16 each (in a class, those after branch 0) is a word, the others lead on.
WIDTH, LEAVES = 32, 16


@dataclass
class Shape:
    #: WIDTH at most.
    classes: int = WIDTH
    table_bits: int = 18
    batch: int = 1024
    rate: float = 0.8
    head_words: int = 1 << 18
    context_words: int = 1 << 14
    node_features: int = 2
    #: Tokens of a shard: at most shard_tokens, but at least spread_tokens where that takes more than spread shards.
    shard_tokens: int = 1 << 22
    spread_tokens: int = 1 << 16
    spread: int = 32


#: Bytes of texts that are taken apart at once: bounds the arrays that tokens need.
PART = 1 << 19


def tokens_of(texts: list[bytes], classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, form, class, bounds): the tokens of all texts, each ended by END; text i has bounds[i]:bounds[i + 1]."""
    hashes, _, _, bounds, form = words_of(texts, forms=True)
    ends = bounds[1:]
    value = np.insert(hashes, ends, END)
    form = np.insert(form, ends, NONE)
    own = (form >> np.uint64(40)).astype(np.int64) % (classes - 1)
    bounds = bounds + np.arange(len(bounds))
    own[bounds[1:] - 1] = classes - 1
    return value, form, own, bounds


class Lookup:
    """Positions of hashes in a table of known ones, by their high bits: hashes are spread evenly."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes, kind="stable")
        self.sorted = hashes[self.order]
        self.bits = max(1, int(len(hashes)).bit_length())
        self.first = np.searchsorted(self.sorted, np.arange((1 << self.bits) + 1, dtype=np.uint64) << np.uint64(64 - self.bits)) if len(hashes) else np.zeros((1 << self.bits) + 1, np.int64)
        self.first[-1] = len(hashes)
        self.longest = int(np.diff(self.first).max()) if len(hashes) else 0

    def __call__(self, values: np.ndarray) -> np.ndarray:
        """Index into the hashes given, or -1."""
        out = np.full(len(values), -1, np.int64)
        if not self.longest:
            return out
        bucket = (values >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.first[bucket], self.first[bucket + 1]
        todo = np.flatnonzero(at < stop)
        for _ in range(self.longest):
            here = at[todo]
            same = self.sorted[here] == values[todo]
            out[todo[same]] = self.order[here[same]]
            todo = todo[~same]
            at[todo] += 1
            todo = todo[at[todo] < stop[todo]]
            if not len(todo):
                break
        return out


def paths(rank: np.ndarray) -> np.ndarray:
    """Branches (three columns, -1: none) of words by their place in the class; 0, -1, -1 where the tree has no more room."""
    out = np.full((len(rank), 3), -1, np.int64)
    out[:, 0] = 0
    far = WIDTH - LEAVES
    one = rank < LEAVES - 1
    out[one, 0] = rank[one] + 1
    r = rank - (LEAVES - 1)
    two = ~one & (r < far * LEAVES)
    out[two, 0], out[two, 1] = LEAVES + r[two] // LEAVES, r[two] % LEAVES
    r = r - far * LEAVES
    three = (r >= 0) & (r < far * far * WIDTH)
    node = r[three] // WIDTH
    out[three, 0], out[three, 1], out[three, 2] = LEAVES + node // far, LEAVES + node % far, r[three] % WIDTH
    return out


class MaxEnt:
    """Weights and vocabulary of the model. All arrays have a size that the shape bounds."""

    def __init__(self, shape: Shape, hashes: np.ndarray, counts: np.ndarray, classes: np.ndarray, rest_count: np.ndarray, rest_kinds: np.ndarray, total: int, kinds: int):
        """hashes, counts, classes: the head, most frequent first; rest_*: sums of each class over the whole vocabulary."""
        self.shape, self.hashes, self.counts, self.classes, self.total, self.kinds = shape, hashes, counts.astype(np.float64), classes, total, kinds
        order = np.argsort(classes, kind="stable")
        rank = np.empty(len(hashes), np.int64)
        rank[order] = np.arange(len(hashes)) - np.searchsorted(classes[order], classes[order])
        self.path = paths(np.where(counts > 1, rank, 1 << 40))
        far, c = WIDTH - LEAVES, shape.classes
        inside = self.path[:, 0] > 0
        kept = [np.bincount(classes[inside], w, c) for w in (self.counts[inside], np.ones(int(inside.sum())))]
        rest_count = rest_count.astype(np.float64) - kept[0]
        self.rest = rest_count + 0.5 * (rest_kinds - kept[1] + 1)
        # Counts of the branches of all nodes, level by level: classes, their groups, the groups' groups.
        nodes, self.bias = classes, []
        for level in range(3):
            take = self.path[:, level] >= 0
            sums = np.zeros((c * far**level, WIDTH))
            np.add.at(sums, (nodes[take], self.path[take, level]), self.counts[take])
            if not level:
                sums[:, 0] = rest_count
            used = sums > 0
            used[:, 0] |= level == 0
            self.bias.append(self._scaled(sums, used))
            nodes = nodes * far + np.maximum(0, self.path[:, level] - LEAVES)
        whole = rest_count + kept[0]
        self.class_bias = self._scaled(np.pad(whole, (0, WIDTH - c))[None, :], np.arange(WIDTH)[None, :] < c)
        bits = min(shape.table_bits, max(12, int(kinds).bit_length() - 1))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros((1 << bits, WIDTH), np.float32)
        self.find = Lookup(hashes)

    def __getstate__(self) -> dict:
        """What tasks get: weights in half precision (the model has no finer ones), the index of hashes made anew."""
        return {k: v for k, v in self.__dict__.items() if k != "find"} | {"table": self.table.astype(np.float16), "path": self.path.astype(np.int8)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = state | {"table": state["table"].astype(np.float32), "path": state["path"].astype(np.int64), "find": Lookup(state["hashes"])}

    @staticmethod
    def _scaled(sums: np.ndarray, used: np.ndarray) -> np.ndarray:
        bias = np.where(used, np.log(sums + 0.5), -1e4).astype(np.float32)
        return bias - bias.max(axis=1, keepdims=True)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.kinds + 1)))

    def rows(self, value: np.ndarray, form: np.ndarray, known: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Hashes of the four context features of each token."""
        context = np.where((known >= 0) & (known < self.shape.context_words), value, form)
        place = np.arange(len(value)) - np.repeat(bounds[:-1], np.diff(bounds))
        back = [np.where(place >= k, np.concatenate((np.full(k, NONE), context))[: len(value)], NONE) for k in (1, 2, 3)]
        pair = mix64(back[0] * np.uint64(0x9E3779B97F4A7C15) + back[1])
        return np.stack([mix64(f + np.uint64((k + 1) * 0xA0761D6478BD642F % (1 << 64))) for k, f in enumerate((*back, pair))])

    def route(self, known: np.ndarray) -> np.ndarray:
        """Branches of each token; words outside the head take branch 0 of their class."""
        if not len(self.path):
            return np.broadcast_to(np.array([0, -1, -1]), (len(known), 3))
        return np.where((known >= 0)[:, None], self.path[np.maximum(known, 0)], np.array([0, -1, -1]))

    def softmaxes(self, features: np.ndarray, own: np.ndarray, path: np.ndarray):
        """For the classes and each level of nodes: (tokens, table rows by feature, exponentials, their sums, branch taken)."""
        far, tokens, node = WIDTH - LEAVES, np.arange(len(own)), own
        for level in range(-1, 3):
            if not len(tokens):
                return
            if level < 0:
                at, bias, taken = (features >> self.shift).astype(np.int64), self.class_bias, own
            else:
                salt = (node.astype(np.uint64) * np.uint64(4) + np.uint64(level + 1)) * np.uint64(0xE7037ED1A0B428DB)
                at = (((features[: self.shape.node_features, tokens] ^ salt) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
                bias, taken = np.take(self.bias[level], node, axis=0), path[tokens, level]
            x = np.take(self.table, at[0], axis=0)
            for row in at[1:]:
                x += np.take(self.table, row, axis=0)
            x += bias
            np.exp(x, out=x)  # in range: weights are bounded, the largest bias of a row is zero
            yield tokens, at, x, x @ np.ones(WIDTH, np.float32), taken
            if level >= 0:
                on = taken >= LEAVES
                tokens, node = tokens[on], (node * far + taken - LEAVES)[on]

    def logs(self, value: np.ndarray, form: np.ndarray, own: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, index in the head) of each token; words outside the head lack their share of branch 0."""
        known = self.find(value)
        path = self.route(known)
        features = self.rows(value, form, known, bounds)
        out = np.zeros(len(value))
        for at in range(0, len(value), self.shape.batch):
            s = slice(at, at + self.shape.batch)
            for tokens, _, x, total, taken in self.softmaxes(features[:, s], own[s], path[s]):
                out[at + tokens] += np.log10(np.maximum(x[np.arange(len(tokens)), taken] / total, 1e-30).astype(np.float64))
        inside = (known >= 0) & (path[:, 0] == 0)
        out[inside] += np.log10((self.counts[known[inside]] + 0.5) / self.rest[own[inside]])
        return out, known

    def learn(self, value: np.ndarray, form: np.ndarray, own: np.ndarray, bounds: np.ndarray, squares: np.ndarray, touched: np.ndarray) -> None:
        """Adagrad steps over the tokens, batch by batch, of the rows of all features of all softmaxes.

        squares and touched have an entry for each table row.
        """
        known = self.find(value)
        path = self.route(known)
        features = self.rows(value, form, known, bounds)
        for at in range(0, len(value), self.shape.batch):
            s = slice(at, at + self.shape.batch)
            rows, grads, of, n = [], [], [], 0
            for tokens, places, x, total, taken in self.softmaxes(features[:, s], own[s], path[s]):
                x /= total[:, None]
                x[np.arange(len(tokens)), taken] -= 1
                rows.append(places.ravel())
                of.append(np.tile(np.arange(n, n + len(tokens)), len(places)))
                grads.append(x)
                n += len(tokens)
            self._step(np.concatenate(rows), np.concatenate(of), np.concatenate(grads), squares, touched)

    def _step(self, rows: np.ndarray, of: np.ndarray, grads: np.ndarray, squares: np.ndarray, touched: np.ndarray) -> None:
        """One step for the table rows, each with the gradients that `of` names."""
        key = np.sort((rows << 32) | np.arange(len(rows)))  # row above, place below: a plain sort of integers is the fastest
        rows, order = key >> 32, key & 0xFFFFFFFF
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        times = np.diff(np.concatenate((first, [len(rows)])))
        total = np.take(grads, of[order[first]], axis=0)
        several = times > 1  # most rows come once: only the others are summed
        if several.any():
            part = np.take(grads, of[order[np.repeat(several, times)]], axis=0)
            total[several] = np.add.reduceat(part, np.cumsum(times[several]) - times[several], axis=0)
        rows = rows[first]
        squares[rows] += np.einsum("ij,ij->i", total, total)
        total *= (self.shape.rate / np.sqrt(squares[rows] + 1)).astype(np.float32)[:, None]  # in place, in 32 bits
        new = np.take(self.table, rows, axis=0)
        new -= total
        np.clip(new, -WEIGHT, WEIGHT, out=new)
        self.table[rows] = new
        touched[rows] += times


BLOCK = 256
#: The most by which the mean change of a row is lengthened, and the touches a shard at which that has faded to a third.
FURTHER, FEW = 4.0, 10.0


def count_words(texts: DataFrame, classes: int, flush: int = 1 << 20) -> DataFrame:
    """(h, own, n): partial counts of tokens by task, from a column of UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        size = 0

        def merged() -> tuple:
            h, own, n = (np.concatenate(c) for c in zip(*kept, strict=True))
            unique, first, back = np.unique(h, return_index=True, return_inverse=True)
            return unique, own[first], np.bincount(back, weights=n).astype(np.int64)

        def out(part: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1].astype(np.int32)), pa.array(part[2])], names=["h", "own", "n"])

        for batch in batches:
            for part in chunks([t or b"" for t in batch.column(0).to_pylist()], len, PART):
                value, _, own, _ = tokens_of(part, classes)
                unique, first, n = np.unique(value, return_index=True, return_counts=True)
                kept.append((unique, own[first], n))
                size += len(unique)
                if size > flush:
                    kept = [merged()]
                    size = len(kept[0][0])
                    if size > flush // 2:
                        yield out(kept[0])
                        kept, size = [], 0
        if kept:
            yield out(merged())

    return texts.mapInArrow(run, "h long, own int, n long")


def vocabulary(docs: DataFrame, shape: Shape) -> tuple[DataFrame, MaxEnt]:
    """The whole count table (h, own, c), and an untrained model with the head of it."""
    vocab = cut(count_words(docs.select("t"), shape.classes).groupBy("h").agg(F.min("own").alias("own"), F.sum("n").alias("c")), "lm-counts")
    sums = vocab.groupBy("own").agg(F.sum("c").alias("c"), F.count("*").alias("k")).collect()  # a row for each class
    counts, kinds = np.zeros(shape.classes, np.int64), np.zeros(shape.classes, np.int64)
    for r in sums:
        counts[r["own"]], kinds[r["own"]] = r["c"], r["k"]
    # The head by a threshold on the count, found in a histogram of sixteenths of octaves: no task orders the vocabulary.
    octave = F.floor(F.log2("c") * 16).cast("int")
    least, held = None, 0
    for r in sorted(vocab.groupBy(octave.alias("o")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r["o"]):  # at most 64 * 16 rows
        held += r["k"]
        if held > shape.head_words:
            break
        least = r["o"]
    top = vocab.filter(octave >= least if least is not None else F.lit(False)).select("h", "c", "own").toArrow()
    head = [np.array(top[c].to_numpy()) for c in ("h", "c", "own")]
    order = np.lexsort((head[0], -head[1]))
    model = MaxEnt(shape, head[0][order].view(np.uint64), head[1][order], head[2][order].astype(np.int64), counts, kinds, int(counts.sum()), int(kinds.sum()))
    return vocab, model


_CHANGES = "block int, salt int, shard int, touched binary, change binary"


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    """(block, salt, shard, touched, mean change): touched has the touches of all rows, then their shards. The change of a row is
    a scale in half precision and a byte for each weight."""
    block, salt, shard, touched, change = zip(*rows, strict=True)
    data = []
    for x in change:
        scale = (np.abs(x).max(axis=1) / 127).astype(np.float16)
        scale[scale == 0] = 1
        data.append(scale.tobytes() + np.clip(np.rint(x / scale[:, None].astype(np.float32)), -127, 127).astype(np.int8).tobytes())
    return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int32()) for x in (block, salt, shard)], pa.array([x.astype(np.float32).tobytes() for x in touched], pa.binary()), pa.array(data, pa.binary())], names=["block", "salt", "shard", "touched", "change"])


def _read(touched: bytes, change: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(touches, shards, mean change) of a block's rows."""
    touches, shards = np.frombuffer(touched, np.float32).reshape(2, -1).astype(np.float64)
    n = len(touches)
    return touches, shards, np.frombuffer(change, np.int8, offset=2 * n).reshape(n, WIDTH) * np.frombuffer(change, np.float16, n).astype(np.float64)[:, None]


def gather(changes: DataFrame) -> DataFrame:
    """The mean change of each block's rows by touches: streamed in two levels in order, a running sum for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, touches, shards, total = None, None, None, None
        mean = lambda: _blocks([(*own, 0, np.stack((touches, shards)), total / np.maximum(touches, 1)[:, None])])
        for batch in batches:
            for block, salt, _, times, change in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                n, k, c = _read(times, change)
                c *= n[:, None]
                if own == (block, salt):
                    touches, shards, total = touches + n, shards + k, total + c
                    continue
                if own:
                    yield mean()
                own, touches, shards, total = (block, salt), n, k, c
        if own:
            yield mean()

    level = lambda rows, *keys: rows.repartition(*keys).sortWithinPartitions("block", "salt", "shard").mapInArrow(run, _CHANGES)
    return level(level(changes, "block", "salt").withColumns({"shard": F.col("salt"), "salt": F.lit(0)}), "block")


def train_round(docs: DataFrame, model: MaxEnt, shards: int, rounds: int) -> None:
    """One round of steps on docs (shard, place, t), shard by shard, and the mean of their changes into the model's table."""
    salts = max(1, int((shards / rounds) ** 0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        own = MaxEnt.__new__(MaxEnt)
        at, held, size = None, [], 0

        def begin():
            own.__dict__ = dict(start.__dict__, table=start.table.copy())
            return np.zeros(len(own.table)), np.zeros(len(own.table))

        def end():
            own.learn(*tokens_of(held, own.shape.classes), squares, touched)
            for b in np.unique(np.flatnonzero(touched) // BLOCK).tolist():
                s = slice(b * BLOCK, (b + 1) * BLOCK)
                yield _blocks([(b, at // rounds % salts, at, np.stack((touched[s], touched[s] > 0)), own.table[s] - start.table[s])])

        for batch in batches:  # steps fall on the same texts however Arrow cuts the batches
            for shard, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard != at:
                    if at is not None:
                        yield from end()
                    at, held, size = shard, [], 0
                    squares, touched = begin()
                held.append(text or b"")
                size += len(held[-1])
                if size >= PART:
                    own.learn(*tokens_of(held, own.shape.classes), squares, touched)
                    held, size = [], 0
        if at is not None:
            yield from end()

    changes = docs.repartition("shard").sortWithinPartitions("shard", "place").select("shard", "t").mapInArrow(run, _CHANGES)
    for row in gather(changes).select("block", "touched", "change").toArrow().to_pylist():  # the table, a byte for a weight
        s = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
        touches, shared_by, change = _read(row["touched"], row["change"])
        # A mean of steps is shorter than their path. Rows of few touches a shard, far from done, move further.
        more = 1 + (np.minimum(np.sqrt(np.maximum(shared_by, 1)), FURTHER) - 1) * np.exp(-touches / np.maximum(shared_by, 1) / FEW)
        model.table[s] = np.clip(model.table[s] + change * more[:, None], -WEIGHT, WEIGHT)
    model.table = model.table.astype(np.float16).astype(np.float32)
    shared.destroy()


def train(docs: DataFrame, shape: Shape) -> tuple[DataFrame, MaxEnt]:
    """Count all words of docs (doc_id, t), then train on all of its rows, a part in each round."""
    vocab, model = vocabulary(docs, shape)
    shards = max(1, min(shape.spread, -(-model.total // shape.spread_tokens)), -(-model.total // shape.shard_tokens))
    rounds = min(shards, 2 + max(0, (shards // shape.spread).bit_length() // 2))
    place = F.xxhash64("doc_id", "t")
    rows = docs.select(F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.xxhash64("t", "doc_id").alias("place"), "t")
    for k in range(rounds):
        train_round(rows.filter(F.col("shard") % rounds == k), model, shards, rounds)
        release(docs.sparkSession)
    return vocab, model


def score(docs: DataFrame, vocab: DataFrame, model: MaxEnt) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of docs (doc_id, t)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        base = own.base(own.counts)
        for batch in batches:
            at = 0
            for part in chunks([t or b"" for t in batch.column(2).to_pylist()], len, PART):
                value, form, classes, bounds = tokens_of(part, own.shape.classes)
                logs, known = own.logs(value, form, classes, bounds)
                inside = known >= 0
                plain = np.where(inside, base[np.maximum(known, 0)], 0.0) if len(base) else np.zeros(len(value))
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (plain, logs, inside.astype(np.int64))]
                # The words outside the head of each text, each once with its number: sorted by text and hash at once.
                out = np.flatnonzero(~inside)
                text = np.searchsorted(bounds, out, side="right") - 1
                order = np.lexsort((value[out], text))
                h, text = value[out][order], text[order]
                first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))) if len(h) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate((first, [len(h)]))).astype(np.int32)
                offsets = pa.array(np.searchsorted(text[first], np.arange(len(part) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (h[first].view(np.int64), times, classes[out][order][first].astype(np.int32))]
                rows = slice(at, at + len(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[rows], batch.column(1)[rows], pa.array(np.diff(bounds)), pa.array(sums[2]), pa.array(sums[0]), pa.array(sums[1]), *lists],
                    names=["uid", "doc_id", "n_tokens", "head_known", "head_base", "head_score", "h", "n", "own"])
                at += len(part)

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "t")
    heads = cut(rows.mapInArrow(run, f"uid long, doc_id {kind}, n_tokens long, head_known long, head_base double, head_score double, h array<long>, n array<int>, own array<int>"), "lm-heads")
    tails = heads.select("uid", F.explode(F.arrays_zip("h", "n", "own")).alias("e")).select("uid", "e.h", "e.n", "e.own")
    rest = docs.sparkSession.createDataFrame([(k, float(x)) for k, x in enumerate(model.rest)], "k int, rest double")  # a row for each class
    known = vocab.select(F.col("h").alias("g"), "c")
    found = tails.join(known, tails["h"] == F.col("g"), "left").join(F.broadcast(rest), F.col("own") == F.col("k"))
    c = F.coalesce(F.col("c"), F.lit(0))
    sums = found.groupBy(F.col("uid").alias("u")).agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(model.total + 0.5 * (model.kinds + 1)))).alias("base"),
        F.sum(F.col("n") * F.log10((c + 0.5) / F.col("rest"))).alias("rest_score"))
    out = heads.select("uid", "doc_id", "n_tokens", "head_known", "head_base", "head_score").join(sums, F.col("uid") == F.col("u"), "left")
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    return out.select(
        "doc_id", "n_tokens", (F.col("head_known") + zero("known")).cast("bigint").alias("n_known"), F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + zero("base")).alias("base_score"), (F.col("head_score") + zero("rest_score")).alias("score"))


def score_texts(docs: DataFrame, shape: Shape | None = None, id_col: str = "doc_id", text_col: str = "text", held_out: tuple[int, int] = (5, 1)) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): train outside the held-out fold, score every row."""
    shape = shape or Shape()
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    vocab, model = train(rows.filter(fold(F.col("doc_id"), held_out[0]) != held_out[1]), shape)
    scored = score(rows, vocab, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), held_out[0]) == held_out[1]).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
