"""Queries for converters, API descriptions, discovery and streams. Those with a SQL form have it; others are tested on literals."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions import convert as V
from ..functions import keys as K
from ..functions import text as T
from ..operators import relational as R
from ..sources import discover as D
from ..sources import registry as sources
from ..streaming import incremental
from .registry import _CANON, _PATHQ, _TITLE, _t, query
from .store import SnapshotStore, own_path


@query()
def html_to_markdown(spark, d):
    """All pages by the plain dialect, links absolute, titles once."""
    pages = _t(spark, d, "pages")
    md = V.html_to_markdown("html", "plain", F.col("url"), T.html_title("html"))
    return pages.select("page_id", md.alias("markdown")).select("page_id", T.content_hash("markdown").alias("sha256"), F.char_length("markdown").alias("n_chars"), T.markdown_title("markdown").alias("title"))


@query()
def html_section_rows(spark, d):
    return _t(spark, d, "pages").select("page_id", F.explode(V.html_sections("html", "h1,h2,h3")).alias("s")).select("page_id", "s.ord", "s.level", "s.title", F.char_length("s.markdown").alias("n_chars"))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _snippet_sql(html: str) -> str:
    """The substitutions in SQL."""
    out = html
    for pattern, value in T.SNIPPET_STEPS:
        out = f"regexp_replace({out}, {_literal(pattern)}, {_literal(value.replace('$', chr(92)))}, 'g')"
    for name, value in T.ENTITIES:
        out = f"replace({out}, {_literal(name)}, {_literal(value)})"
    for pattern, value in (*T.SNIPPET_LINES, (r"^[\s\p{Z}]+", ""), (r"[\s\p{Z}]+$", "")):
        out = f"regexp_replace({out}, {_literal(pattern)}, {_literal(value)}, 'g')"
    return out


@query(f"SELECT page_id, sha256({_snippet_sql('html')}) AS sha256 FROM pages")
def html_to_markdown_simple(spark, d):
    """The same by substitutions alone, in the JVM."""
    return _t(spark, d, "pages").select("page_id", T.content_hash(T.html_to_markdown_simple("html")).alias("sha256"))


@query()
def mdx_to_markdown(spark, d):
    """Documents as MDX: a component around each text."""
    mdx = F.concat(F.lit("import X from './x'\n\n<Note>\n"), F.col("source"), F.lit("\n</Note>\n\n"), F.coalesce("text", F.lit("")))
    return _t(spark, d, "documents").select("doc_id", T.content_hash(V.mdx_to_markdown(mdx)).alias("sha256"))


@query()
def wikitext_to_markdown(spark, d):
    wiki = F.concat(F.lit("== "), F.col("source"), F.lit(" ==\n{{Note|"), F.col("lang"), F.lit("}}\n"), F.coalesce("text", F.lit("")))
    return _t(spark, d, "documents").select("doc_id", T.content_hash(V.wikitext_to_markdown(wiki)).alias("sha256"))


@query()
def rst_to_markdown(spark, d):
    """Conversations as documents of a corpus with a label each; every text refers to the label of its source."""
    docs = _t(spark, d, "documents")
    rst = F.concat(F.lit(".. _l"), F.col("doc_id").cast("string"), F.lit(":\n\nDocument "), F.col("doc_id").cast("string"), F.lit("\n====================\n\nSee :ref:`l"), F.col("doc_id").cast("string"), F.lit("`.\n\n"), F.coalesce("text", F.lit("")))
    made = V.rst_to_markdown(docs.select(F.col("doc_id").cast("string").alias("name"), rst.alias("text")))
    return made.select("name", F.regexp_extract("markdown", r"See \[([^\]]*)\]", 1).alias("label"), T.content_hash("markdown").alias("sha256"))


@query("SELECT source, '{\"id\": ' || CAST(count(*) AS VARCHAR) || '}' AS json FROM documents GROUP BY 1")
def yaml_to_json(spark, d):
    counted = _t(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return counted.select("source", V.yaml_to_json(F.concat(F.lit("id: "), F.col("n").cast("string"))).alias("json"))


@query("SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id) - 1 AS INTEGER) AS ord, " + _CANON + " AS url FROM pages")
def sitemap_urls(spark, d):
    """Each page's URL as a shard of its own."""
    url = F.replace(K.canonical_url("url", suffix=".html"), F.lit("&"), F.lit("&amp;"))
    shards = _t(spark, d, "pages").select("page_id", F.concat(F.lit("<urlset><url><loc>"), url, F.lit("</loc></url></urlset>")).alias("xml"))
    return D.sitemap_urls(shards, keep=("page_id",))


@query(rf"""WITH p AS (SELECT regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS host, {_PATHQ} AS path, page_id FROM pages)
SELECT path, CAST(max(page_id) AS VARCHAR) AS lastmod FROM p WHERE host = (SELECT min(host) FROM p) GROUP BY 1""")
def sharded_sitemap(spark, d):
    """Pages as shards of a sitemap, of which one host's entries are kept, of a path the last."""
    pages = _t(spark, d, "pages")
    host = pages.agg(F.min(K.url_host("url"))).first()[0]
    shards = pages.select(F.col("page_id").alias("shard"), F.concat(F.lit("<urlset><url><loc>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</loc><lastmod>"), F.col("page_id").cast("string"), F.lit("</lastmod></url></urlset>")).alias("xml"))
    return D.sharded_sitemap(shards, host)[0]


def _in_forties(column: str):
    """column with the number of a run of forty ids, so that no text grows with the table."""
    return F.concat_ws("-", F.col(column), F.floor(F.col("doc_id") / 40).cast("string"))


@query("SELECT lang || '-' || CAST(doc_id // 40 AS VARCHAR) AS source, CAST(max_by(title, doc_id) AS VARCHAR) AS first_title, count(*) AS n, count(DISTINCT section) AS sections FROM (SELECT lang, source AS section, 'T' || CAST(doc_id AS VARCHAR) AS title, doc_id FROM documents) GROUP BY 1")
def link_index(spark, d):
    """A link index of each language and forty ids, its sources as sections."""
    docs = _t(spark, d, "documents").withColumn("lang", _in_forties("lang"))
    item = F.concat(F.lit("- [T"), F.col("doc_id").cast("string"), F.lit("](https://x.test/"), F.col("doc_id").cast("string"), F.lit(".md): "), F.col("source"))
    sections = docs.groupBy("lang", "source").agg(F.concat(F.lit("## "), F.col("source"), F.lit("\n"), F.array_join(F.array_sort(F.collect_list(item)), "\n")).alias("part"))
    index = sections.groupBy(F.col("lang").alias("source")).agg(F.array_join(F.array_sort(F.collect_list("part")), "\n").alias("text"))
    rows = D.link_index(index)
    return rows.groupBy("source").agg(F.max_by("title", F.regexp_extract("title", r"(\d+)", 1).cast("bigint")).alias("first_title"), F.count("*").alias("n"), F.count_distinct("section").alias("sections"))


@query("SELECT source, CAST(doc_id AS VARCHAR) AS url, CAST(length(regexp_replace(text, '\\s+$', '')) AS INTEGER) AS n FROM documents")
def concatenated_pages(spark, d):
    """All documents of a source as one text, in slices of forty ids, taken apart again."""
    docs = _t(spark, d, "documents").withColumn("slice", F.floor(F.col("doc_id") / 40))
    page = F.concat(F.lit("# T\nSource: "), F.col("doc_id").cast("string"), F.lit("\n"), F.coalesce("text", F.lit("")))
    whole = docs.groupBy("source", "slice").agg(F.array_join(F.array_sort(F.collect_list(page)), "\n").alias("text"))
    return D.concatenated_pages(whole, order="slice").select("source", "url", F.char_length(F.regexp_replace("body", r"\s+$", "")).alias("n"))


@query("SELECT source || '-' || CAST(doc_id // 40 AS VARCHAR) AS source, lang || '/' || CAST(doc_id AS VARCHAR) || '.md' AS path, sha256(text) AS sha FROM documents WHERE lang IN ('en', 'fr')")
def tree_files(spark, d):
    """Documents as blobs of repository trees, one for each source and forty ids; two folders count."""
    docs = _t(spark, d, "documents").withColumn("source", _in_forties("source"))
    blob = F.struct(F.lit("blob").alias("type"), F.concat(F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), T.content_hash("text").alias("sha"))
    trees = docs.groupBy("source").agg(F.to_json(F.struct(F.lit(False).alias("truncated"), F.collect_list(blob).alias("tree"))).alias("json"))
    return D.tree_files(trees, ["en/", "fr/"], [".md"]).select("source", "path", "sha")


_SPEC = '{"openapi":"3.0.0","servers":[{"url":"https://{h}/v1","variables":{"h":{"default":"api.test"}}}],"components":{"schemas":{"Item":{"type":"object","required":["id"],"properties":{"id":{"type":"string","format":"uuid"},"next":{"$ref":"#/components/schemas/Item"}}}}},"paths":{"/a/{id}":{"parameters":[{"name":"id","in":"path","required":true,"schema":{"type":"string"}}],"get":{"summary":"Get","tags":["A","B"],"responses":{"200":{"description":"OK","content":{"application/json":{"schema":{"$ref":"#/components/schemas/Item"}}}}}},"delete":{"summary":"Delete","parameters":[{"name":"force","in":"query","schema":{"type":"boolean"}}]}},"/b":{"post":{"tags":[],"requestBody":{"content":{"application/json":{"schema":{"type":"array","items":{"type":"string"}}}}}}}}}'


def _specs(spark, d):
    """A description for each source."""
    return _t(spark, d, "documents").select("source").distinct().withColumn("spec", F.lit(_SPEC))


@query("SELECT source, path, method, tag, summary FROM (SELECT DISTINCT source FROM documents), (VALUES ('/a/{id}', 'get', 'A', 'Get'), ('/a/{id}', 'get', 'B', 'Get'), ('/a/{id}', 'delete', 'Untagged', 'Delete'), ('/b', 'post', 'Untagged', NULL)) v(path, method, tag, summary)")
def endpoint_explode(spark, d):
    return V.exploded_endpoints(_specs(spark, d))


@query("SELECT source, path, method, CAST(ord AS INTEGER) AS ord, name, place FROM (SELECT DISTINCT source FROM documents), (VALUES ('/a/{id}', 'get', 0, 'id', 'path'), ('/a/{id}', 'delete', 0, 'id', 'path'), ('/a/{id}', 'delete', 1, 'force', 'query')) v(path, method, ord, name, place)")
def parameter_explode(spark, d):
    return V.all_parameters(_specs(spark, d))


@query()
def endpoint_markdown(spark, d):
    return V.endpoint_documents(_specs(spark, d)).select("source", "path", "method", "tag", "file", T.content_hash("markdown").alias("sha256"))


@query("SELECT source, 'object' || chr(10) || '- `id` (string (uuid)) **required**' || chr(10) || '- `next` (`Item` (circular reference))' AS text FROM (SELECT DISTINCT source FROM documents)")
def schema_type_text(spark, d):
    return _specs(spark, d).select("source", V.schema_type_text(F.lit('{"$ref":"#/components/schemas/Item"}'), F.col("spec")).alias("text"))


@query("SELECT source, 'openapi' AS format FROM (SELECT DISTINCT source FROM documents)")
def spec_routing(spark, d):
    return _specs(spark, d).select("source", V.spec_format("spec").alias("format"))


def _listing_sql() -> str:
    rows = ", ".join("(" + ", ".join([str(k), *map(_literal, (x.name, x.discovery, ",".join(x.formats), x.converter, x.url, x.token, x.failure)), str(x.requires_auth)]) + ")" for k, x in enumerate(sources.SOURCES.values()))
    return f"SELECT name, discovery, formats, converter, url, token, failure, requires_auth, pages FROM (VALUES {rows}) v(k, name, discovery, formats, converter, url, token, failure, requires_auth) JOIN (SELECT page_id % {len(sources.SOURCES)} AS k, count(*) AS pages FROM pages GROUP BY 1) p USING (k)"


@query(_listing_sql())
def source_listing(spark, d):
    """All sources, with the number of pages of each; pages are dealt to them by id."""
    names = list(sources.SOURCES)
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("page_id") % len(names) + 1).cast("int"))
    counted = _t(spark, d, "pages").groupBy(name.alias("name")).agg(F.count("*").alias("pages"))
    return sources.listing(spark).join(counted, "name")


@query("SELECT event_type, count(*) AS keys FROM (SELECT DISTINCT event_type, user_id FROM events) GROUP BY 1")
def incremental_stream(spark, d):
    """Events as a file stream, merged batch by batch into a snapshot of one row for each key."""
    root = own_path(spark, "stream")
    store = SnapshotStore(spark, f"{root}/snapshot")
    static = spark.read.parquet(f"{d}/events.parquet")
    static.select("event_id", "event_type", "user_id", "value").write.parquet(f"{root}/landed")
    schema = "event_id long, event_type string, user_id long, value double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/landed")
    rows = stream.select(F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("key"), T.content_hash(F.col("value").cast("string")).alias("sha256"), F.col("event_id").alias("ord"))
    incremental.maintain(rows, store, f"{root}/checkpoint").awaitTermination()
    return store.read(incremental.SNAPSHOT).groupBy(F.split_part("key", F.lit(":"), F.lit(1)).alias("event_type")).agg(F.count("*").alias("keys"))


@query(f"SELECT page_id, {_TITLE} AS title, '# ' || {_TITLE} AS heading FROM pages")
def page_preamble(spark, d):
    pages = _t(spark, d, "pages").select("page_id", T.html_title("html").alias("title"), "url")
    made = pages.select("page_id", "title", T.with_preamble(F.concat(F.lit("# "), F.col("title"), F.lit("\n\nBody")), "title", "url").alias("md"))
    return made.select("page_id", "title", F.get(F.split("md", "\n"), F.lit(0)).alias("heading"))


@query("SELECT doc_id, CASE WHEN n = 1 THEN s ELSE s || '-' || CAST(n AS VARCHAR) END AS name FROM (SELECT doc_id, source AS s, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS n FROM documents)")
def output_decollide(spark, d):
    return R.decollided(_t(spark, d, "documents").select("doc_id", "lang", "source"), "lang", "source", "doc_id", "name").select("doc_id", "name")
