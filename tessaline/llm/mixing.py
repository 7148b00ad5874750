"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the total by its weight; a share above `max_epochs` times what the source has is clamped
there, and the excess goes to the others in proportion to their weights until none is above. A document is then taken
floor(target / size of source) times, and the fractional repetition goes to a seeded choice of documents whose words add
up to what is missing: documents stand in the order of a seeded hash, and those before the point where the running sum
reaches the missing words are taken once more (the one across that point if that brings the sum nearer).

All arithmetic up to the level is on integers, so reruns agree to the bit. The running sum never needs a source in one
task: sums per (source, hash bucket) come first, and only rows of one bucket are ordered together.

Defined results: null text has size 0; null sources are one source, the last; a null doc_id hashes as ''; repeated rows
count each; an empty table gives an empty result; sources of size 0 have target 0. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)


def ranked(sources: DataFrame) -> DataFrame:
    """Number sources by code point, null last, from 0. Ranges are numbered apart and shifted, so no task holds all."""
    by_range = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    by_range = cut(by_range, "mix-ranges")
    before = (
        by_range.groupBy("part").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
        .select("part", F.coalesce("before", F.lit(0)).alias("before"))
    )  # one row for each range: bounded by the number of partitions
    inside = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return by_range.withColumn("inside", inside).join(before, "part").withColumn("rank", F.col("before") + F.col("inside") - 1).drop("part", "before", "inside")


def water_level(sources: DataFrame, share_num: int, share_den: int, max_epochs: int) -> DataFrame:
    """Add target to (source, source_size, weight). The level is (num * S / den - clamped caps) / (weights left)."""
    state = cut(sources.withColumn("cap", F.col("source_size") * max_epochs), "mix-sources")
    total = state.agg(F.sum("source_size")).first()[0] or 0
    num, den = 0, 1
    while True:
        clamped = F.col("cap") * F.lit(den) <= F.col("weight") * F.lit(num)
        caps, left = state.agg(F.coalesce(F.sum(F.when(clamped, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0))).first()
        if not left:
            break
        new = (share_num * total - share_den * int(caps), share_den * int(left))
        if new[0] * den <= num * new[1]:
            break
        num, den = new
    level = F.when(F.lit(den) * F.col("cap") <= F.lit(num) * F.col("weight"), F.col("cap").cast("double"))
    return state.withColumn("target", level.otherwise(F.col("weight") * F.lit(num).cast("double") / F.lit(den).cast("double")))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
    share: tuple[int, int] = (3, 2), max_epochs: int = 2, seed: int = 1, bucket_digits: int = 3, keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, weight, target, repeats, taken) of each row, and the columns in keep.

    share is the fraction of all words that the mix has; bucket_digits hex digits of the hash name a bucket (16**digits for
    each source; more for sources with over 10**9 documents).
    """
    identity = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), identity).cast("binary")).alias("draw"), *[F.col(c).alias(f"kept_{c}") for c in keep],
    )
    slim = cut(slim, "mix-sizes").withColumn("bucket", F.substring("draw", 1, bucket_digits))
    sums = cut(slim.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    sources = ranked(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    pick: Column = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    level = water_level(sources.select("source", "source_size", pick.cast("bigint").alias("weight")), *share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    level = level.withColumn("whole", whole).withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size")).drop("cap")
    before = F.coalesce(F.sum("bucket_size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = (
        sums.withColumn("bucket_before", before).drop("bucket_size").withColumnRenamed("source", "s")
        .join(level, F.col("s").eqNullSafe(F.col("source"))).select(F.col("s").alias("source"), F.col("bucket").alias("b"), "bucket_before", "source_size", "weight", "target", "whole", "missing")
        .withColumnRenamed("source", "s")
    )
    rows = slim.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    order = W.partitionBy("source", "bucket").orderBy("draw", F.col("doc_id").asc_nulls_first(), "size")
    ran = F.col("bucket_before") + F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    # Taken once more if at least half of the document lies before the point; without a missing word, none is.
    extra = (2 * F.col("ran") + F.col("size") <= 2 * F.col("missing")) & (F.col("missing") > 0)
    rows = rows.withColumn("ran", ran).withColumn("repeats", F.col("whole") + F.when(extra, 1).otherwise(0))
    return rows.select("doc_id", "source", "size", "source_size", "weight", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"), *[F.col(f"kept_{c}").alias(c) for c in keep])


#: The same in SQL, for the contract's parameters.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2 * CAST(sum(size) AS BIGINT) AS cap,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM d GROUP BY source),
f AS (SELECT *, sum(cap) OVER w AS caps, sum(weight) OVER w AS weights, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weights
      FROM s WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, (cap * 2 * (all_weights - weights + weight) <= weight * (3 * total - 2 * (caps - cap))) AS clamped FROM f),
l AS (SELECT 3 * max(total) - 2 * coalesce(sum(CASE WHEN clamped THEN cap END), 0) AS num, 2 * sum(CASE WHEN NOT clamped THEN weight ELSE 0 END) AS den FROM c),
t AS (SELECT source, source_size, CASE WHEN clamped THEN CAST(cap AS DOUBLE) ELSE weight * CAST(num AS DOUBLE) / CAST(den AS DOUBLE) END AS target FROM c, l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) - d.size AS ran
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN target - whole * source_size > 0 AND 2 * ran + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
