"""Graph operators: reachability, orphans, links to pages, labels, chained keys, flattened trees."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.store import cut_here
from . import relational as R


def reachable(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, depth) of every node reachable from roots over edges (src, dst), with the smallest depth.

    Breadth first: each round joins the frontier alone and leaves out what was seen, so cycles end; rounds
    go on until the frontier is empty. They are cut in durable files; the driver sees counts.
    """
    seen = cut_here(roots.select(F.col(roots.columns[0]).alias("node")).distinct().withColumn("depth", F.lit(0)))
    frontier = seen
    for depth in count(1):
        step = edges.join(frontier, edges["src"] == frontier["node"]).select(F.col("dst").alias("node")).filter("node IS NOT NULL").distinct()
        frontier = cut_here(step.join(seen.select(F.col("node").alias("__seen")), F.col("node") == F.col("__seen"), "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        seen = cut_here(seen.unionByName(frontier))
    return seen


def reachable_sql(spark: SparkSession, edges: str, roots: str, levels: int = 100) -> DataFrame:
    """The same for graphs without long chains, as one recursive query over two views; a path array guards against cycles."""
    return spark.sql(f"""
        WITH RECURSIVE walk(node, depth, path) MAX RECURSION LEVEL {levels} AS (
          SELECT node, 0, array(node) FROM {roots}
          UNION ALL
          SELECT e.dst, w.depth + 1, array_append(w.path, e.dst) FROM walk w JOIN {edges} e ON e.src = w.node WHERE NOT array_contains(w.path, e.dst))
        SELECT node, min(depth) AS depth FROM walk GROUP BY node""")


def orphans(nodes: DataFrame, edges: DataFrame, roots: DataFrame, key: str = "node") -> DataFrame:
    found = reachable(edges, roots).select(F.col("node").alias("__found"))
    return nodes.join(found, F.col(key) == F.col("__found"), "left_anti")


def resolve_links(links: DataFrame, pages: DataFrame, aliases: DataFrame, target: str = "target") -> DataFrame:
    """links with resolved and kind: 'page', 'alias', or 'external' where neither knows the target (it stays as it is).

    pages: (target, page); aliases: (target, alias_of).
    """
    p = pages.select(F.col("target").alias("__p"), F.col("page").alias("__page")).dropDuplicates(["__p"])
    a = aliases.select(F.col("target").alias("__a"), F.col("alias_of").alias("__alias")).dropDuplicates(["__a"])
    joined = links.join(p, F.col(target) == F.col("__p"), "left").join(a, F.col(target) == F.col("__a"), "left")
    kind = F.when(F.col("__p").isNotNull(), "page").when(F.col("__a").isNotNull(), "alias").otherwise("external")
    return joined.withColumn("resolved", F.coalesce("__page", "__alias", target)).withColumn("kind", kind).drop("__p", "__page", "__a", "__alias")


def resolve_labels(roles: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Corpus-wide second pass: roles (label, shown) with the heading their label stands for; the last definition wins."""
    last = labels.groupBy(F.col(label).alias("__l")).agg(F.max_by(F.struct("doc", "slug", "title"), "ord").alias("__at"))
    joined = roles.join(last, F.col(label) == F.col("__l"), "left")
    return joined.withColumn("text", F.coalesce("shown", "__at.title", label)).withColumn("href", F.when(F.col("__at").isNotNull(), F.concat(F.col("__at.doc"), F.lit(".md#"), F.col("__at.slug")))).drop("__l", "__at")


def chained(start: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """Equi-joins one after the other: each step is (table, left key, right key); rows without a partner go."""
    out = start
    for n, (table, left, right) in enumerate(steps):
        part = table.withColumnRenamed(right, f"__k{n}")
        out = out.join(part, out[left] == part[f"__k{n}"]).drop(f"__k{n}")
    return out


def flattened(nodes: DataFrame, key: str = "id", parent: str = "parent", name: str = "name") -> DataFrame:
    """(key, depth, path): each node of a forest with the names from its root down. No node comes below itself, so cycles end."""
    level = nodes.filter(F.col(parent).isNull()).select(F.col(key).alias("__id"), F.lit(0).alias("depth"), F.array(name).alias("path"), F.array(key).alias("__ids"))
    level = out = cut_here(level)
    for depth in count(1):
        below = nodes.join(level, (nodes[parent] == level["__id"]) & ~F.coalesce(F.array_contains("__ids", nodes[key]), F.lit(False)))
        level = cut_here(below.select(nodes[key].alias("__id"), F.lit(depth).alias("depth"), F.array_append("path", nodes[name]).alias("path"), F.array_append("__ids", nodes[key]).alias("__ids")))
        if level.isEmpty():
            break
        out = cut_here(out.unionByName(level))
    return out.drop("__ids").withColumnRenamed("__id", key)


def derived_parents(paths: DataFrame, column: str = "path", wanted: Sequence[int] = ()) -> DataFrame:
    """(path): every proper ancestor of every path, once; wanted names the depths that count (all, if empty)."""
    from ..functions.keys import parent_paths

    up = paths.select(F.explode(parent_paths(column)).alias(column)).distinct()
    return up.filter(F.size(F.split(column, "/")).isin(*wanted)) if wanted else up


def reading_order(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, place, depth, parent, caption, title, number): depth first from roots (node, ord), each node where it is first met.

    edges: (src, ord, dst), maybe caption and title. place has the number of the entry taken at each step, so that its order is
    the reading order: of the ways to a node without a node twice, the smallest one is that of a depth-first walk. Rounds
    hand improved ways down the edges and end when none improves, so cycles end; a forest may have several roots. number
    counts from 1 over all, by ranges, so no task orders all nodes.
    """
    none = F.lit(None).cast("string")
    extra = [F.col(c).alias(c) if c in edges.columns else none.alias(c) for c in ("caption", "title")]
    links = edges.filter("dst IS NOT NULL").select("src", F.col("ord").cast("bigint").alias("ord"), "dst", *extra)
    way = F.min_by(F.struct("place", "nodes", "parent", "caption", "title"), "place").alias("w")
    first = roots.select(F.col(roots.columns[0]).alias("node"), F.array(F.col("ord").cast("bigint")).alias("place"), F.array(roots.columns[0]).alias("nodes"), F.lit(None).cast(edges.schema["src"].dataType).alias("parent"), none.alias("caption"), none.alias("title"))
    best = cut_here(first.groupBy("node").agg(way).select("node", "w.*"))
    better = best
    while not better.isEmpty():
        step = links.join(better.select(F.col("node").alias("__from"), F.col("place").alias("__place"), F.col("nodes").alias("__nodes")), F.col("src") == F.col("__from")).filter(~F.array_contains("__nodes", F.col("dst")))
        offered = step.select(F.col("dst").alias("node"), F.array_append("__place", F.col("ord")).alias("place"), F.array_append("__nodes", F.col("dst")).alias("nodes"), F.col("src").alias("parent"), "caption", "title")
        offered = offered.groupBy("node").agg(way).select("node", "w.*")
        old = best.select(F.col("node").alias("__node"), F.col("place").alias("__old"))
        better = cut_here(offered.join(old, F.col("node") == F.col("__node"), "left").filter(F.col("__old").isNull() | (F.col("place") < F.col("__old"))).drop("__node", "__old"))
        best = cut_here(best.join(better.select(F.col("node").alias("__node")), F.col("node") == F.col("__node"), "left_anti").unionByName(better))
    found = best.select("node", "place", (F.size("place") - 1).alias("depth"), "parent", "caption", "title")
    return R.numbered(found, [], ["place"], "number")


def reading_lines(order: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """(number, line): order as nested list items, with a heading where a caption begins; titles (node, name) for entries without their own."""
    shown = order if titles is None else order.join(titles.select(F.col("node").alias("__t"), F.col("name").alias("__name")), F.col("node") == F.col("__t"), "left").drop("__t")
    name = F.coalesce(F.nullif("title", F.lit("")), *([F.col("__name")] if titles is not None else []), F.col("node"))
    item = F.concat(F.repeat(F.lit("  "), F.greatest(F.col("depth") - 1, F.lit(0))), F.lit("- ["), name, F.lit("]("), F.col("node"), F.when(~F.contains("node", F.lit("://")), F.lit(".md")).otherwise(F.lit("")), F.lit(")"))
    # A caption counts for the entries right below it: it begins where the entry before it, among a parent's, has another.
    before = F.lag("caption").over(W.partitionBy("parent").orderBy("place"))
    begins = (F.col("depth") == 1) & (F.coalesce("caption", F.lit("")) != "") & ~F.col("caption").eqNullSafe(before)
    return shown.withColumn("line", F.when(begins, F.concat(F.lit("## "), F.col("caption"), F.lit("\n\n"), item)).otherwise(item)).select("number", "line")
