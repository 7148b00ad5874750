"""Document fingerprints: SimHash of 128 bits over weighted terms, and a search by permuted block tables.

Terms are a text's words (A-Z lowered) and pairs of neighbouring words. Each term's 128-bit hash votes on signed bits with the
bit length of the term's count as its weight; a bit is set where the votes are above zero. Weights and votes are whole
numbers, so a fingerprint is the same wherever it is made.

Search: a fingerprint's bits are cut into radius + 2 blocks. Of two fingerprints within radius bits at least two blocks are
equal, so there is a table for every pair of blocks, each keyed by those two blocks (the permutation that brings them to the
front), and an equi-join on (table, key) meets every neighbour; the distance is checked in the join, and a pair that meets in
several tables is given once. Tables hold distinct fingerprints, so copies never meet each other.

The text that follows in the order of ids is met in one pass: rows are dealt by ranges, sorted within partitions and
streamed with the row before; where a partition ends, the first row of the next one is joined to its last.

Defined results: null text is empty; a text without words has fingerprint zero. The order is by doc_id (null first), then by
the text's SHA-256; repeated rows stay and follow each other. The last row's next is the first; a single row's next is
itself. Extra columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, cut, mix64, small_batches, words_of

BITS, RADIUS = 128, 4
_PAIR, _SECOND = np.uint64(0x9FB2_1C65_1E98_DF25), np.uint64(0xA0761D6478BD642F)


def votes(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Signed votes of 64-bit terms on BITS bits; weights are whole."""
    total = np.zeros(BITS)
    for at in range(0, len(terms), 1 << 14):
        part, weight = terms[at : at + (1 << 14)], weights[at : at + (1 << 14)]
        wide = np.column_stack((mix64(part), mix64(part ^ _SECOND))).astype("<u8")
        bits = np.unpackbits(wide.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        total += 2.0 * (weight @ bits.astype(np.float64)) - weight.sum()
    return total


def fingerprints(texts: list[bytes]) -> list[bytes]:
    """The fingerprint of each UTF-8 text, 16 bytes."""
    out = []
    for part in chunks(texts, len):
        words, _, _, bounds = words_of(part)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = words[lo:hi]
            terms, counts = np.unique(np.concatenate((own, mix64(own[:-1] * _PAIR + own[1:]))), return_counts=True)
            out.append(np.packbits(votes(terms, np.frexp(counts)[1].astype(np.float64)) > 0, bitorder="little").tobytes())
    return out


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1.0 - (int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_count() / BITS


def edited(text: str, following: str) -> str:
    """text with its last half (rounded down) replaced by the first as many code points of following, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ROW = "doc_id {kind}, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_EDGE = "pid int, edge string, text binary"


def _row(doc_id, text: str, print_: bytes, made: bytes, made_print: bytes, next_print: bytes) -> tuple:
    return doc_id, len(text), hashlib.sha256(made).hexdigest(), print_, made_print, likeness(print_, made_print), likeness(print_, next_print)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _schema(kind: pa.DataType, edges: bool) -> pa.Schema:
    fields = [("doc_id", kind), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    return pa.schema(fields + ([("pid", pa.int32()), ("edge", pa.string()), ("text", pa.binary())] if edges else []))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), prints as bytes, of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), body.alias("text"))
    # The last key spreads rows that are equal in all.
    order = [F.col("doc_id").asc_nulls_first(), F.col("sha"), F.col("spread")]
    rows = rows.withColumn("sha", F.sha2("text", 256)).withColumn("spread", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, before, schema = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if not len(batch):
                continue
            schema = schema or _schema(batch.column(0).type, True)
            ids, raw = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [b.decode("utf-8", "replace") for b in raw]
            prints, out = fingerprints(raw), []
            if before is None:
                out.append((ids[0], len(texts[0]), None, prints[0], None, None, None, pid, "first", raw[0]))
            run_of = ([before] if before else []) + list(zip(ids, texts, prints, strict=True))
            made = [edited(a[1], b[1]).encode() for a, b in zip(run_of, run_of[1:])]  # noqa: B905  neighbours
            out += [(*_row(*a, m, p, b[2]), None, None, None) for a, b, m, p in zip(run_of, run_of[1:], made, fingerprints(made), strict=False)]
            before = run_of[-1]
            if out:
                yield _table(out, schema)
        if before:
            yield _table([(before[0], len(before[1]), None, before[2], None, None, None, pid, "last", before[1].encode())], schema)

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    parts = cut(dealt.mapInArrow(run, f"{_ROW.format(kind=kind)}, {_EDGE}"), "prints")
    # Edges: a row for each partition. The first of the next partition that has rows follows each last; the last of all meets the first.
    place = lambda side: parts.filter(F.col("edge") == side)
    number = F.row_number().over(Window.orderBy("pid"))
    lasts = place("last").select("doc_id", "text", F.col("fingerprint").alias("print"), number.alias("k"))
    firsts = place("first").select(F.col("text").alias("next"), F.col("fingerprint").alias("next_print"), number.alias("k1"))
    many = place("first").count()
    edges = lasts.join(firsts, F.col("k") % F.lit(max(many, 1)) + 1 == F.col("k1"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, raw, print_, following, next_print in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                text = raw.decode("utf-8", "replace")
                made = edited(text, following.decode("utf-8", "replace")).encode()
                out.append(_row(doc_id, text, print_, made, fingerprints([made])[0], next_print))
            if out:
                yield _table(out, _schema(batch.column(0).type, False))

    closed = edges.select("doc_id", "text", "print", "next", "next_print").mapInArrow(close, _ROW.format(kind=kind))
    return parts.filter("edge IS NULL").select(*closed.columns).unionByName(closed)


def _words64(print_: Column | str) -> tuple[Column, Column]:
    """The two halves of a fingerprint as long."""
    digits = F.hex(print_)
    half = lambda at: F.conv(F.substring(digits, at, 16), 16, -10).cast("bigint")
    return half(1), half(17)


def distance(a: Column | str, b: Column | str) -> Column:
    """Bits in which two fingerprints differ."""
    (a1, a2), (b1, b2) = _words64(a), _words64(b)
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))


def block_tables(prints: DataFrame, radius: int = RADIUS, print_col: str = "fingerprint") -> DataFrame:
    """(table, key, and the columns of prints): a row for each pair of radius + 2 blocks of bits, keyed by the bits of those two."""
    blocks = radius + 2
    if not 0 <= radius <= BITS - 2:
        raise ValueError("the radius leaves no blocks")
    edge = [round(k * BITS / blocks) for k in range(blocks + 1)]
    bits = F.concat(*[F.lpad(F.conv(F.substring(F.hex(print_col), at, 8), 16, 2), 32, "0") for at in (1, 9, 17, 25)])
    block = lambda k: F.substring("__bits", edge[k] + 1, edge[k + 1] - edge[k])
    keyed = [F.struct(F.lit(t).alias("table"), F.xxhash64(F.lit(t), block(a), block(b)).alias("key")) for t, (a, b) in enumerate(combinations(range(blocks), 2))]
    return prints.withColumn("__bits", bits).withColumn("__t", F.explode(F.array(*keyed))).select("__t.*", *prints.columns)


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fingerprint, distance): for each distinct fingerprint of queries all distinct ones of prints at radius bits or fewer."""
    asked = block_tables(queries.select("fingerprint").distinct(), radius).withColumnRenamed("fingerprint", "query").withColumnRenamed("table", "__table").withColumnRenamed("key", "__key")
    held = block_tables(prints.select("fingerprint").distinct(), radius)
    far = distance("query", "fingerprint")
    met = asked.join(held, (F.col("__table") == F.col("table")) & (F.col("__key") == F.col("key")) & (far <= radius))
    return met.select("query", "fingerprint", far.alias("distance")).distinct()


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, every: int = 20) -> DataFrame:
    """with_next() with prints in hex, and n_near: of rows whose id is divisible by every, how many other rows lie within radius bits (else null)."""
    rows = cut(with_next(docs, id_col, text_col), "prints-whole")
    asks = F.col("doc_id").cast("bigint") % every == 0
    counts = cut(rows.groupBy("fingerprint").agg(F.count("*").alias("copies"), F.bool_or(F.coalesce(asks, F.lit(False))).alias("asked")), "prints-distinct")
    met = within(counts.filter("asked"), counts, radius).join(counts.select(F.col("fingerprint").alias("__f"), "copies"), F.col("fingerprint") == F.col("__f"))
    near = met.groupBy("query").agg((F.sum("copies") - 1).alias("__near"))
    # Rows that ask nothing stay out of the join: they would all meet under one null key.
    asked = rows.filter(asks).join(near, F.col("fingerprint") == F.col("query"), "left").drop("query")
    out = asked.unionByName(rows.filter(~F.coalesce(asks, F.lit(False))).withColumn("__near", F.lit(None).cast("bigint")))
    return out.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"), F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next", F.col("__near").alias("n_near"))
