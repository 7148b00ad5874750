"""The flagship: landed pages become a catalogue with titles, classes, links and hashes, in one scan and one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as T
from .registry import _H1, _HREF, _PATHQ, _PLAIN, _TITLE, query


def described(pages: DataFrame) -> DataFrame:
    """(page_id, url, path, category, title, sha256, n_chars, n_links) of landed pages."""
    path = K.url_path("url")
    rows = pages.select(
        "page_id", K.canonical_url("url", suffix=".html").alias("url"), path.alias("path"), K.category_and_slug(path)["category"].alias("category"),
        T.first_present(T.html_title("html"), T.html_heading("html"), path).alias("title"), T.plain_text("html").alias("body"), F.size(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("n_links"))
    return rows.select("page_id", "url", "path", "category", "title", T.content_hash("body").alias("sha256"), F.char_length("body").alias("n_chars"), "n_links")


@query(f"""SELECT CASE WHEN contains({_PATHQ}, '/') AND {_PATHQ} <> '/' THEN string_split({_PATHQ}, '/')[1] ELSE 'general' END AS category, count(*) AS pages, count(DISTINCT sha256({_PLAIN})) AS texts,
CAST(sum(length({_PLAIN})) AS BIGINT) AS chars, CAST(sum(len({_HREF})) AS BIGINT) AS links, min(coalesce(nullif({_TITLE}, ''), nullif({_H1}, ''), {_PATHQ})) AS first_title FROM pages GROUP BY 1""")
def corpus_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = described(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return pages.groupBy("category").agg(
        F.count("*").alias("pages"), F.count_distinct("sha256").alias("texts"), F.sum("n_chars").alias("chars"), F.sum("n_links").alias("links"), F.min("title").alias("first_title"))
