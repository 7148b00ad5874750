"""Catalogues: groups, counts, rollups, listings, fingerprints. All aggregates are partial before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str, name: str = "rows") -> DataFrame:
    """Rows of each group as an array of structs in order."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in columns if c != order]))).alias(name))


def counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def rollup_counts(df: DataFrame, group: str, subgroup: str) -> DataFrame:
    """(group, subgroup, level, n): subgroups (level 0), groups (1) and the total (3)."""
    return df.rollup(group, subgroup).agg(F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level"))


def listing(df: DataFrame, keys: Sequence[str], line: Column, order: str, name: str = "lines") -> DataFrame:
    """Lines of each group joined by line breaks, in order."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(pairs, lambda e: e["line"]), "\n").alias(name))


def fingerprint(df: DataFrame, keys: Sequence[str], columns: Sequence[str], engine: str = "", digits: int = 3) -> DataFrame:
    """(keys, fingerprint, n_rows): an order-free SHA-256 of each group's rows, with the engine's version in it.

    Row hashes are sorted and hashed within buckets of their first hex digits, then the buckets' hashes, so that a hot group
    is never gathered at once: a task sees one bucket, or at most 16**digits of them.
    """
    row = F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]).cast("binary"), 256)
    whole = lambda x: F.sha2(F.array_join(F.array_sort(F.collect_list(x)), "\n").cast("binary"), 256)
    rows = df.select(*keys, row.alias("__row")).withColumn("__bucket", F.substring("__row", 1, digits))
    buckets = rows.groupBy(*keys, "__bucket").agg(whole(F.col("__row")).alias("__hash"), F.count("*").alias("__n"))
    listed = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "__bucket", "__hash"))), "\n")
    return buckets.groupBy(*keys).agg(F.sha2(F.concat_ws("\n", F.lit(engine), listed).cast("binary"), 256).alias("fingerprint"), F.sum("__n").alias("n_rows"))


def with_rest(index: DataFrame, pages: DataFrame, key: str = "key", group: str = "section", other: str = "Other") -> DataFrame:
    """pages with the group that index (key, group, ...) gives them; index rows without a page go, pages without an index row are in other."""
    named = index.join(pages.withColumnRenamed(key, "__key"), F.col(key) == F.col("__key")).drop("__key")
    rest = pages.join(index.select(F.col(key).alias("__key")), F.col(key) == F.col("__key"), "left_anti").withColumn(group, F.lit(other))
    return named.unionByName(rest, allowMissingColumns=True)


def inverted(df: DataFrame, key: str, members: str, name: str) -> DataFrame:
    """(member, key): a row for each distinct member of each key's array."""
    return df.select(F.explode(F.array_distinct(members)).alias(name), key)


def histogram(df: DataFrame, items: Column, name: str = "item") -> DataFrame:
    """How often each item of an array column occurs."""
    return df.select(F.explode(items).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def readme(df: DataFrame, title: Column, category: str, line: Column, order: str) -> DataFrame:
    """(category, content): a Markdown page for each category with its sorted lines and their number."""
    body = listing(df, [category], line, order).join(counts(df, category).withColumnRenamed(category, "__c"), F.col(category).eqNullSafe(F.col("__c"))).drop("__c")
    return body.select(category, F.concat(F.lit("# "), title, F.lit("\n\n"), F.col("n").cast("string"), F.lit(" pages.\n\n"), F.col("lines"), F.lit("\n")).alias("content"))
