"""Removal of strings that occur twice or more, by distributed prefix doubling.

A position's rank at length L names the L units (bytes, or words) from there; equal units, equal rank. Rank pairs make ranks
at twice the length: rank(i, 2L) names the pair rank(i, L), rank(i + L, L), and any length up to 2L the pair at a smaller
offset. Names are fingerprints of pairs rather than dense numbers, so ranks are made where the text is, without a global
numbering; what Spark sorts and counts are the rank pairs of positions at growing offsets. Positions whose pair is unique
drop out, until the threshold is passed.

Sorting all positions in every round would shuffle a multiple of the text. Every round but the last therefore sorts a
*synchronised sample*, a front filter that loses nothing:

* Length T/4: in each window of T units the position of the lowest rank is the window's anchor. Equal windows have equal
  anchors at equal offsets, so a window whose anchor's rank is unique is unique. There is about one anchor in 3T/8 units.
* Windows that share an anchor form one stretch, named by the pair of the ranks at length T at its both ends. Equal stretches
  collapse to one row, with their number: if that is two or more, all of their windows repeat. One of each kind goes on,
  together with those that occur once, where an anchor has more than one kind.
* Lengths T/2 and 7T/8: windows whose anchor lies T - L + 1 neighbouring offsets deep share a core of L units. Where the core's
  rank pair is unique, all of these windows are.
* Length T: what is left is sorted at every position. Windows whose rank pair occurs twice or more repeat.

Matches never cross documents, as ranks never do. Copies of a document collapse like any other equal stretches, and equal
stretches within a text (periodic ones have one at every unit) collapse before they leave their task. No group is collected:
hot ranks are counts by partial aggregation and rows of equi-joins that AQE splits; a text's spans are merged, so their list
is bounded by the text. Long texts are ranked in segments of bounded memory.

Units: bytes, or words (runs of anything but white space, A-Z in lower case). A passage of words reaches from its first word's
first byte to its last word's last byte.

Defined results: null text is empty; texts shorter than T are kept whole; equal documents of T units or more are removed
whole, all of them (of words: up to the white space around them); repeated rows are documents of their own; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, cut, drop_cut, mix64, small_batches, words_of

_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Windows that are ranked at once: bounds the arrays that a long text needs.
SEGMENT = 1 << 19


def pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The names of pairs of ranks."""
    x = one * _ONE
    x ^= x >> np.uint64(32)
    x += two
    x *= _TWO
    x ^= x >> np.uint64(29)
    return x


class Ranks:
    """Ranks of all starts in an array of units, at one length after another."""

    def __init__(self, units: np.ndarray, most: int):
        """most: the smallest length that will be asked for."""
        if units.dtype == np.uint8 and most >= 8:  # eight bytes are a rank of 64 bits as they stand
            self.size = 8
            n = max(0, len(units) - 7)
            self.rank = np.ndarray((n,), "<u8", np.ascontiguousarray(units).data, 0, (1,)).copy() if n else np.zeros(0, np.uint64)
        else:
            self.size, self.rank = 1, mix64(units.astype(np.uint64))

    def pairs(self, length: int) -> tuple[np.ndarray, int]:
        """(rank, offset): the units of that length from i have the rank pair rank[i], rank[i + offset]."""
        while 2 * self.size < length:
            self.rank = pair(self.rank[: -self.size], self.rank[self.size :])
            self.size *= 2
        return self.rank, max(0, length - self.size)

    def at(self, length: int) -> np.ndarray:
        rank, offset = self.pairs(length)
        return pair(rank[: len(rank) - offset], rank[offset:])


def units_of(texts: list[bytes], words: bool) -> tuple[np.ndarray, np.ndarray]:
    """All units of the texts in one array; text i has bounds[i]:bounds[i + 1]."""
    if words:
        value, _, _, bounds = words_of(texts)
        return value, bounds
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), np.uint8), bounds


def anchors(units: np.ndarray, bounds: np.ndarray, threshold: int) -> tuple[np.ndarray, ...]:
    """(text index, anchor rank, stretch name, anchor position, lo, hi): windows start lo to hi units before the anchor."""
    k = max(1, threshold // 4)
    w = threshold - k + 1
    n_windows = np.maximum(0, np.diff(bounds) - threshold + 1)
    total = int(n_windows.sum())
    if not total:
        return (np.zeros(0, np.int64),) * 6
    ranks = Ranks(units, k)
    rank = ranks.at(k)
    # The lowest rank of each run of w positions, the leftmost among equals: order bits above, position below.
    low = np.uint64((1 << 32) - 1)
    packed = (rank & ~low) | np.arange(len(rank), dtype=np.uint64)
    grid = np.concatenate((packed, np.full(-len(packed) % w, np.uint64(2**64 - 1)))).reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    runs = len(packed) - w + 1
    at = (np.minimum(behind[:runs], ahead[w - 1 : w - 1 + runs]) & low).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), n_windows)
    first = np.cumsum(n_windows) - n_windows
    start = np.arange(total) - first[text] + bounds[:-1][text]
    at = at[start]
    begin = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]))))
    last = np.concatenate((begin[1:], [total])) - 1
    s, e, p, t = start[begin], start[last], at[begin], text[begin]
    full = ranks.at(threshold)
    stretch = pair(full[s] + (e - s).astype(np.uint64), full[e])  # shorter than 2T: the ranks of both ends cover it
    return t, rank[p], stretch, p - bounds[:-1][t], p - e, p - s


def merged(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of texts as maximal runs, by text and start."""
    if not len(text):
        return text, start, stop
    order = np.lexsort((start, text))
    text, start, stop = text[order], start[order], stop[order]
    far = int(stop.max()) + 1
    reach = np.maximum.accumulate(text * far + stop) - text * far  # the furthest stop so far of the same text
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (start[1:] > reach[:-1])))
    begin = np.flatnonzero(new)
    return text[begin], start[begin], reach[np.concatenate((begin[1:], [len(text)])) - 1]


def _segments(units: np.ndarray, bounds: np.ndarray, threshold: int):
    """(units, bounds, index of the first text, position of its first unit): a text of more windows than SEGMENT in parts."""
    if len(units) <= SEGMENT + threshold:
        yield units, bounds, 0, 0
        return
    for i in range(len(bounds) - 1):
        for a in range(bounds[i], max(bounds[i] + 1, bounds[i + 1] - threshold + 1), SEGMENT):
            part = units[a : min(a + SEGMENT + threshold - 1, bounds[i + 1])]
            yield part, np.array([0, len(part)]), i, a - bounds[i]


_ANCHORS = "h long, s long, key binary, at int, lo int, hi int, n int"


def _anchor_rows(threshold: int, words: bool):
    """Rows of anchors: each kind of stretch of a text once, with its number n. A kind with more than one leaves the runs that its
    windows cover as settled rows as well: h null, start at - hi, stop at - lo + threshold, as with all others."""

    def rows(texts: list[bytes], keys: list[bytes]) -> pa.RecordBatch:
        found = []
        units, bounds = units_of(texts, words)
        for part, own, i, a in _segments(units, bounds, threshold):
            t, h, s, at, lo, hi = anchors(part, own, threshold)
            found.append((t + i, h, s, at + a, lo, hi))
        t, h, s, at, lo, hi = (np.concatenate(c) for c in zip(*found, strict=True))
        h, s = h.astype(np.uint64), s.astype(np.uint64)
        order = np.lexsort((s, h, t))
        same = np.concatenate(([False], (t[order][1:] == t[order][:-1]) & (h[order][1:] == h[order][:-1]) & (s[order][1:] == s[order][:-1]))) if len(t) else np.zeros(0, bool)
        group = np.cumsum(~same) - 1
        n = np.bincount(group) if len(t) else np.zeros(0, np.int64)
        first = order[~same]
        again = order[n[group] > 1]
        settled, start, stop = merged(t[again], (at - hi)[again], (at - lo)[again] + threshold)
        none = np.zeros(len(settled), np.uint64)
        names = pa.array(keys, pa.binary()).take(pa.array(np.concatenate((t[first], settled))))
        column = lambda x, y, kind: pa.array(np.concatenate((x[first], y)).astype(kind))
        known = np.concatenate((np.zeros(len(first), bool), np.ones(len(settled), bool)))
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate((h[first], none)).view(np.int64), mask=known), pa.array(np.concatenate((s[first], none)).view(np.int64), mask=known), names,
            column(at, start, np.int32), column(lo, threshold - (stop - start), np.int32), column(hi, 0 * start, np.int32), pa.array(np.concatenate((n, 0 * settled)).astype(np.int32))],
            names=["h", "s", "key", "at", "lo", "hi", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(k, t) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t is not None and len(t) >= threshold]
            for part in chunks(pairs, lambda r: len(r[1]), SEGMENT):
                yield rows([r[1] for r in part], [r[0] for r in part])

    return run


def _piece_rows(threshold: int, words: bool):
    """The bytes of the stretches wanted: array of (rid, at, lo, hi) for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rid, at, lo, hi = (x.to_numpy() for x in wanted.values.flatten())
                begin, end = (at - hi).astype(np.int64), (at - lo).astype(np.int64) + threshold
                if words:
                    _, first, last, _ = words_of([text])
                    begin, end = first[begin], last[end - 1]
                pieces = [text[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                for k in range(0, len(pieces), 8192):
                    s = slice(k, k + 8192)
                    left = pa.ListArray.from_arrays(pa.array(np.arange(len(rid[s]) + 1, dtype=np.int32)), pa.StructArray.from_arrays([pa.array(lo[s]), pa.array(hi[s])], names=["lo", "hi"]))
                    yield pa.RecordBatch.from_arrays([pa.array(rid[s]), pa.array(pieces[s], pa.binary()), pa.array(hi[s]), left], names=["rid", "piece", "hi", "left"])

    return run


def _core_rows(threshold: int, length: int, words: bool):
    """Rank pairs at that length of the cores of all neighbourhoods that are left. left: list of (lo, hi) offsets."""
    width = threshold - length + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in chunks(batch.column(1).to_pylist(), len, SEGMENT):
                here = slice(at, at + len(part))
                at += len(part)
                rid, top, left = (batch.column(i)[here] for i in (0, 2, 3))
                units, bounds = units_of(part, words)
                rank, offset = Ranks(units, length).pairs(length)
                lo, hi = (x.to_numpy() for x in left.flatten().flatten())
                piece = np.repeat(np.arange(len(part)), pa.compute.list_value_length(left).to_numpy())
                # Windows that start j*width to j*width + width - 1 units before the anchor share what follows the latest start.
                times = hi // width - lo // width + 1
                span = np.repeat(np.arange(len(lo)), times)
                j = (lo // width)[span] + np.arange(len(span)) - (np.cumsum(times) - times)[span]
                core = (bounds[:-1] + top.to_numpy())[piece[span]] - j * width
                one, two = rank[core].view(np.int64), rank[core + offset].view(np.int64)
                columns = (rid.to_numpy()[piece[span]], np.maximum(lo[span], j * width).astype(np.int32), np.minimum(hi[span], j * width + width - 1).astype(np.int32), one, two)
                for k in range(0, len(span), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(x[k : k + (1 << 16)]) for x in columns], names=["rid", "lo", "hi", "one", "two"])

    return run


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """Add key: 16 bytes of the text's SHA-256, by which equal texts are one."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select("*", text.alias("__tsl_bytes"), F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("__tsl_key"))


def repeated_spans(docs: DataFrame, text_col: str = "text", threshold: int = 400, words: bool = False, lengths: tuple[float, ...] = (0.5, 0.875)) -> DataFrame:
    """(key, spans array<struct<start, stop>>): stretches to remove of each text that has any, in units; they may overlap."""
    small_batches(docs.sparkSession)
    texts = _keyed(docs.select(text_col), text_col).select("__tsl_key", "__tsl_bytes")
    found = cut(texts.mapInArrow(_anchor_rows(threshold, words), _ANCHORS), "suffix-anchors")
    # Counts are cut before they are joined: a join of two plain exchanges is one whose hot keys AQE can split.
    again = cut(found.filter("h IS NOT NULL").groupBy(F.col("h").alias("g")).agg(F.sum("n").alias("n")).filter("n > 1").select("g"), "suffix-again")
    held = cut(found.join(again, found["h"] == again["g"]).drop("g"), "suffix-held")
    settled = cut(found.filter("h IS NULL").select("key", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + threshold).alias("stop")), "suffix-settled")
    drop_cut(found)
    kinds = cut(held.groupBy("h", "s").agg(F.sum("n").alias("n"), F.min(F.struct("key", "at", "lo", "hi")).alias("one")), "suffix-kinds")
    several = cut(kinds.groupBy(F.col("h").alias("g")).agg(F.count("*").alias("kinds")).filter("kinds > 1").select("g"), "suffix-several")
    # The number of a row is fixed as soon as the cut has it.
    open_ = kinds.join(several, kinds["h"] == several["g"]).select("one.*", (F.col("n") > 1).alias("known"), F.monotonically_increasing_id().alias("rid"))
    open_ = cut(open_, "suffix-open")

    # The bytes of the stretches that are left, one text of each kind. Copies of a text go before texts move (partial aggregate).
    wanted = open_.groupBy(F.col("key").alias("k")).agg(F.collect_list(F.struct("rid", "at", "lo", "hi")).alias("wanted"))
    single = texts.dropDuplicates(["__tsl_key"])
    rows = single.join(wanted, single["__tsl_key"] == wanted["k"]).select("__tsl_bytes", "wanted")
    pieces = cut(rows.mapInArrow(_piece_rows(threshold, words), "rid long, piece binary, hi int, left array<struct<lo: int, hi: int>>"), "suffix-pieces")

    left = None
    for length in (*[max(2, min(threshold, round(x * threshold))) for x in lengths], threshold):
        rows = pieces
        if left is not None:
            by_piece = left.groupBy(F.col("rid").alias("r")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
            rows = pieces.join(by_piece, pieces["rid"] == by_piece["r"]).select("rid", "piece", "hi", F.col("spans").alias("left"))
        ranked = cut(rows.mapInArrow(_core_rows(threshold, length, words), "rid long, lo int, hi int, one long, two long"), "suffix-ranks")
        pairs = cut(ranked.groupBy(F.col("one").alias("o"), F.col("two").alias("t")).agg(F.count("*").alias("n")).filter("n > 1").select("o", "t"), "suffix-pairs")
        now = cut(ranked.join(pairs, (ranked["one"] == pairs["o"]) & (ranked["two"] == pairs["t"])).select("rid", "lo", "hi"), "suffix-left")
        drop_cut(ranked, pairs, *([] if left is None else [left]))
        left = now

    sure = kinds.filter("n > 1").select(F.col("h").alias("a"), F.col("s").alias("b"))
    whole = held.join(sure, (held["h"] == sure["a"]) & (held["s"] == sure["b"])).select("key", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + threshold).alias("stop"))
    # Neighbouring windows of a piece as one span: lo less its place in order is the same for neighbours.
    place = F.row_number().over(Window.partitionBy("rid").orderBy("lo"))
    runs = left.select("rid", "lo", (F.col("lo") - place).alias("run")).groupBy("rid", "run").agg(F.min("lo").alias("lo"), F.max("lo").alias("hi"))
    alone = open_.filter("NOT known").select(F.col("rid").alias("r"), "key", "at")
    dense = runs.join(alone, runs["rid"] == alone["r"]).select("key", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + threshold).alias("stop"))
    spans = settled.unionByName(whole).unionByName(dense).groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    out = cut(spans, "suffix-spans")
    drop_cut(held, again, settled, kinds, several, open_, pieces, left)
    return out


def decoded(data: Column) -> Column:
    """UTF-8 bytes as text without the bytes of characters that were cut in two (what is valid stays byte for byte)."""

    @F.pandas_udf("string")
    def decode(parts: pd.Series) -> pd.Series:
        return parts.map(lambda b: bytes(b).decode("utf-8", "ignore"), na_action="ignore")

    return decode(data)


def _runs(text: bytes, spans, words: bool) -> list[tuple[int, int]]:
    """Spans as maximal runs of bytes."""
    start, stop = (x.to_numpy().astype(np.int64) for x in spans.flatten())
    _, start, stop = merged(np.zeros(len(start), np.int64), start, stop)
    if words:
        _, first, last, _ = words_of([text])
        start, stop = first[start], last[stop - 1]
    return list(zip(start.tolist(), stop.tolist(), strict=True))


def remove_repeats(docs: DataFrame, text_col: str = "text", threshold: int = 400, words: bool = False, passages: int | None = None) -> DataFrame:
    """docs without text but with kept_bytes binary, n_bytes, n_removed, n_spans, kept_sha256 (in place of columns so named); every row stays.

    threshold counts bytes, or words; n_bytes and n_removed are bytes either way. With passages, n_passage_bytes has the bytes
    in passages of that many words that occur elsewhere; they are counted on the input and stay.
    """
    made = ["kept_bytes", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["n_passage_bytes"] if passages else [])]
    names = [c for c in docs.columns if c != text_col and c not in made]
    rows = _keyed(docs, text_col)
    spans = repeated_spans(docs, text_col, threshold, words).select(F.col("key").alias("__tsl_span_key"), F.col("spans").alias("__tsl_spans"))
    if passages:
        also = repeated_spans(docs, text_col, passages, True).select(F.col("key").alias("__tsl_also"), F.col("spans").alias("__tsl_passages"))
        both = spans.join(also, spans["__tsl_span_key"] == also["__tsl_also"], "full")
        spans = cut(both.select(F.coalesce("__tsl_span_key", "__tsl_also").alias("__tsl_span_key"), "__tsl_spans", "__tsl_passages"), "suffix-both")
    found = [c for c in spans.columns if c != "__tsl_span_key"]
    rows = rows.join(spans, rows["__tsl_key"] == spans["__tsl_span_key"], "left").select(*[f"`{c}`" for c in names], "__tsl_bytes", *found)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sha, counts = [], [], [[] for _ in range(len(made) - 2)]
            for text, *own in zip(batch.column(len(names)).to_pylist(), *(batch.column(len(names) + 1 + k) for k in range(len(found))), strict=True):
                runs = [_runs(text, x.values, words or k > 0) if x.is_valid else [] for k, x in enumerate(own)]
                at, parts = 0, []
                for a, b in runs[0]:
                    parts.append(text[at:a])
                    at = b
                left = b"".join([*parts, text[at:]])
                kept.append(left)
                sha.append(hashlib.sha256(left).hexdigest())
                for column, n in zip(counts, (len(text), len(text) - len(left), len(runs[0]), *(sum(b - a for a, b in x) for x in runs[1:])), strict=True):
                    column.append(n)
            longs = [pa.array(x, pa.int64()) for x in counts]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], pa.array(kept, pa.binary()), *longs[:3], pa.array(sha, pa.string()), *longs[3:]], names=[*names, *made])

    added = "kept_bytes binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", n_passage_bytes long" * bool(passages)
    return rows.mapInArrow(run, ", ".join(filter(None, (schema, added))))
