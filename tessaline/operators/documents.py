"""One page as many documents: their paths, the map from anchors to documents, and links rewritten by a join over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import convert as V
from ..functions import keys as K
from . import relational as R


def sliced(pages: DataFrame, kinds: Sequence[Sequence[str]], source: str = "source", html: str = "html", dialect: str = "docbook") -> DataFrame:
    """(source, ord, parent, kind, path, title, anchors, markdown): the documents of each page, in its order.

    A document's path has the names of those above it; equal paths of a page are made unique.
    """
    rows = pages.select(source, F.explode(V.html_slices(html, [list(k) for k in kinds], dialect)).alias("s")).select(source, "s.*")
    path = F.array_join(F.transform("trail", lambda t: K.slug(t)), "/")
    return R.decollided(rows.withColumn("path", path), source, "path", "ord", "__unique").withColumn("path", F.concat("__unique", F.lit(".md"))).select(source, "ord", "parent", "kind", "path", "title", "anchors", "markdown")


def anchor_map(documents: DataFrame, source: str = "source") -> DataFrame:
    """(source, anchor, path, is_top): where each anchor of a page has gone; of an anchor that stands twice, the first."""
    rows = documents.select(source, "ord", "path", F.explode("anchors").alias("anchor"), F.get("anchors", F.lit(0)).alias("__any"))
    return R.first_wins(rows.drop("__any"), [source, "anchor"], ["ord"]).select(source, "anchor", "path")


def relinked(documents: DataFrame, source: str = "source", text: str = "markdown", page: str = "") -> DataFrame:
    """documents with links to anchors of the page (`#x`, or page followed by it) as links to the documents that have them now.

    A document's own anchors stay as they are, and so do anchors that no document has. Only a document's distinct links meet
    the map, by an equi-join; its text is put together again from what stands between them.
    """
    opening = rf"\]\((?:\Q{page}\E)?#" if page else r"\]\(#"
    named = documents.select(source, F.col("path").alias("__doc"), F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(opening + r"([^)\s]+)"), F.lit(1)))).alias("anchor"))
    found = named.join(anchor_map(documents, source), [source, "anchor"])
    href = F.when(F.col("path") == F.col("__doc"), F.concat(F.lit("#"), "anchor")).otherwise(F.concat(K.relative_link("__doc", "path"), F.lit("#"), "anchor"))
    links = found.select(F.col(source).alias("__s"), "__doc", F.struct("anchor", href.alias("href")).alias("l")).groupBy("__s", "__doc").agg(F.map_from_entries(F.collect_set("l")).alias("__links"))  # of one document
    joined = documents.join(links, F.col(source).eqNullSafe(F.col("__s")) & (F.col("path") == F.col("__doc")), "left").drop("__s", "__doc")
    parts = F.split(text, opening)
    name = lambda p: F.regexp_extract(p, r"^([^)\s]*)", 1)
    again = lambda p: F.concat(F.lit("]("), F.coalesce(F.try_element_at("__links", name(p)), F.concat(F.lit("#"), name(p))), F.regexp_replace(p, r"^[^)\s]*", ""))
    whole = F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), again), ""))
    return joined.withColumn(text, F.when(F.size(parts) > 1, whole).otherwise(F.col(text))).drop("__links")
