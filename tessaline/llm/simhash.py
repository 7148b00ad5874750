"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has bit i set where over half of the XXH64 values of a text's word shingles have it set. Two fingerprints at
2 bits or fewer have a value within 1 bit of both in common, so every *distinct* fingerprint emits itself and its 64
one-bit variants, the variants are shuffled, and those that collide on a variant are linked and verified. At most 65
fingerprints can share a variant (they all lie in its ball), so no group grows with the data, and copies of a text never
meet: they share one fingerprint. Linking each to the smallest in its ball keeps all links' components, since any two in
one ball link with it there; distinct links go through connected components on fingerprints, not on documents.

Defined results: null and empty texts, and those of white space only, have fingerprint zero and link like any other.
Repeated rows stay. A null doc_id stays, and is no candidate for the smallest id unless its class has no other.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _LOWER, _SPACE, cut, small_batches
from .components import components


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one UTF-8 text."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([1], _SPACE[data].view(np.int8), [1]))))
    begin, end = edge[0::2], edge[1::2]
    if not len(begin):
        return 0
    # Words joined by one space each: word i starts at the lengths before it plus i.
    flat = b" ".join(data.tobytes().split())
    size = end - begin
    start = np.cumsum(size + 1) - size - 1
    stop = start + size
    n = max(1, len(begin) - shingle + 1)
    last = stop[shingle - 1 :] if len(begin) >= shingle else stop[-1:]
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(flat[a:b], seed) for a, b in zip(start[:n].tolist(), last.tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = values[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp long, and the columns in keep) of every row; fp is the fingerprint as a signed 64-bit number."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *keep])

    schema = ", ".join(f"`{n}` {docs.schema[c].dataType.simpleString()}" for n, c in (("doc_id", id_col), *zip(keep, keep, strict=True)))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *keep).mapInArrow(run, schema.replace(", ", ", fp long, ", 1) if keep else f"{schema}, fp long")


def ball_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between distinct fp at up to radius bits, enough of them for the components."""
    if radius not in (0, 1, 2):
        raise ValueError("half the radius must be at most one bit")
    variants = [F.lit(0).cast("bigint"), *([F.shiftleft(F.lit(1).cast("bigint"), i) for i in range(64)] if radius else [])]
    # Each print makes 65 rows: prints are few and dense in their files, so they are spread first.
    prints = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    balls = prints.select("fp", F.explode(F.array(*variants)).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    groups = balls.groupBy("variant").agg(F.collect_set("fp").alias("near")).filter(F.size("near") > 1)
    if radius == 2:
        pairs = groups.select(F.array_min("near").alias("b"), F.explode("near").alias("a"))
    else:  # within one bit, not all of a ball link with each other
        pairs = groups.filter(F.array_contains("near", F.col("variant"))).select(F.col("variant").alias("b"), F.explode("near").alias("a"))
    return pairs.filter(F.col("a") != F.col("b")).distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fingerprint, component_id, component, and the columns in keep) of each row of docs.

    component_id is the smallest id reachable by links, component the root fingerprint of the class.
    """
    rows = cut(fingerprints(docs, id_col, text_col, shingle, keep), "simhash")
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = components(ball_links(distinct.select("fp"), radius))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = placed.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component_id"))
    classes = placed.join(lowest, placed["root"] == lowest["r"]).select(F.col("fp").alias("f"), "component_id", F.col("root").alias("component"))
    return rows.join(classes, rows["fp"] == classes["f"]).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component", *keep)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of docs that represent their class: one with its smallest id (nulls last), and of equal ids the smallest text hash.

    Only narrow rows are compared: (fingerprint class, id, text hash), minima by partial aggregation.
    """
    names = docs.columns
    key = F.substring(F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")), 256)), 1, 16)
    keyed = docs.withColumn("__tsl_key", key)
    classes = cut(near_duplicates(keyed, id_col, text_col, shingle, radius, keep=("__tsl_key",)), "simhash-classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("__tsl_key").alias("key"))
    # Classes are told by their root fingerprints, so those without any id stay apart.
    first = cut(classes.groupBy("component").agg(F.min(order).alias("first")).select("first.id", F.col("first.key").alias("key")), "simhash-first")
    same = keyed[id_col].eqNullSafe(first["id"]) & (keyed["__tsl_key"] == first["key"])
    kept = keyed.join(first, same, "left_semi")
    # Rows that repeat id and text: one stays. Narrow rows tell whether there are any, before texts move for it.
    again = classes.groupBy("doc_id", "__tsl_key").count().filter("count > 1").limit(1).count()
    return (kept.dropDuplicates([id_col, "__tsl_key"]) if again else kept).select(*names)
