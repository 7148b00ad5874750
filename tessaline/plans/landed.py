"""Queries over what sources land: indexes, bundles, replies and specs are built from the tables, row by row different, and read back."""

from __future__ import annotations

import hashlib
import zlib
from base64 import b64encode
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import convert as V
from ..functions import filters as P
from ..functions import html_md, wiki_md
from ..functions import keys as K
from ..functions import text as T
from ..operators import catalogue as C
from ..operators import relational as R
from ..operators import state as S
from ..sources import crawl as W
from ..sources import discover as D
from ..sources import transport as N
from ..sources.registry import SourceSpec
from . import run
from .registry import _t, query
from .store import SnapshotStore, cut_here, own_path
from .sync import Options, archive_raw, engine_of, export_markdown, recovered, remove_exported, synchronise, synchronise_in_parts, version_tasks


def _f(pattern: str, *columns) -> Column:
    """A text with `%` in the place of each column."""
    parts = pattern.split("%")
    values = [c if isinstance(c, Column) else F.col(c).cast("string") for c in columns]
    return F.concat(F.lit(parts[0]), *[x for v, p in zip(values, parts[1:], strict=True) for x in (v, F.lit(p))])


def _whole(rows: DataFrame, key: Column, order: str, item: Column, before: str = "", between: str = "\n", after: str = "", name: str = "text") -> DataFrame:
    """(source, name): one document for each key (regions, a handful each), its items in order."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("i"))))
    return rows.groupBy(key.alias("source")).agg(F.concat(F.lit(before), F.array_join(F.transform(pairs, lambda p: p["i"]), between), F.lit(after)).alias(name))


def _nations(spark, d, item: Column, *around, name: str = "text") -> DataFrame:
    return _whole(_t(spark, d, "nation"), _f("r%", "n_regionkey"), "n_nationkey", item, *around, name=name)


_SRC = "'r' || CAST(n_regionkey AS VARCHAR) AS source"
_PLACE = "CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER)"

# ------------------------------------------------------------------ discovery


@query("SELECT CAST(0 AS INTEGER) AS ord, url FROM pages")
def sitemap_by_path(spark, d):
    """Each page's URL as a shard with a name space."""
    xml = _f('<s:urlset xmlns:s="http://www.sitemaps.org/schemas/sitemap/0.9"><s:url><s:loc>%</s:loc></s:url></s:urlset>', F.replace("url", F.lit("&"), F.lit("&amp;")))
    return D.sitemap_by_path(_t(spark, d, "pages").select(xml.alias("xml")))


@query("SELECT source, unnest(generate_series(2, CAST(ceil(count(*) / 20.0) AS INTEGER))) AS page FROM documents GROUP BY 1 HAVING count(*) > 20")
def paged_requests(spark, d):
    sizes = _t(spark, d, "documents").groupBy("source").agg(F.ceil(F.count("*") / 20).alias("total_pages"))
    return D.paged(sizes).withColumn("page", F.col("page").cast("bigint"))


@query("SELECT count(*) AS titles, true AS all_fit FROM documents")
def request_batches(spark, d):
    sizes = D.batched(_t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("title"))).groupBy("batch").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("titles"), (F.max("n") <= 50).alias("all_fit"))


@query(f"SELECT {_SRC}, 'G' || CAST(n_nationkey % 2 AS VARCHAR) AS grp, 'p' || CAST(n_nationkey AS VARCHAR) AS slug, n_name || ' & co' AS title FROM nation")
def sidebar_links(spark, d):
    """A sidebar for each region: a group heading before each link, and a second link to the same page."""
    item = _f('<h3 class="nav group">G%</h3><a href="/docs/p%/"><b>%</b> &amp; co</a><a href="/docs/p%#x">again</a><a href="/blog/%">no</a>', F.col("n_nationkey") % 2, "n_nationkey", "n_name", "n_nationkey", "n_nationkey")
    return D.sidebar(_nations(spark, d, item, name="html"), "/docs").select("source", "grp", "slug", "title")


@query(f"""SELECT {_SRC}, CAST(0 AS INTEGER) AS depth, '' AS parents, 'Region' AS title, CAST(NULL AS VARCHAR) AS page FROM nation GROUP BY n_regionkey UNION ALL
SELECT {_SRC}, 1, 'Region', n_name, 'n/' || CAST(n_nationkey AS VARCHAR) || '.md' FROM nation""")
def nested_navigation(spark, d):
    navs = _nations(spark, d, _f("      - '%': n/%.md", "n_name", "n_nationkey"), "site_name: x\nnav:\n  - Region:\n", "\n", "\ntheme: y\n")
    return D.navigation(navs).select("source", "depth", F.array_join("parents", "/").alias("parents"), "title", "page")


@query(f"SELECT {_SRC}, {_PLACE} AS ord, 'c/' || lower(n_name) AS name FROM nation")
def sphinx_index(spark, d):
    return D.sphinx_names(_nations(spark, d, _f('"c/%"', F.lower("n_name")), 'Search.setIndex({"docnames": [', ", ", '], "titles": []})', name="script"))


@query("SELECT 'r' || CAST(n_regionkey AS VARCHAR) AS src, 'All' AS caption, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE '' END AS title, 'n' || CAST(n_nationkey AS VARCHAR) AS dst FROM nation")
def toctree_entries(spark, d):
    entry = F.when(F.col("n_nationkey") % 2 == 0, _f("   % <n%>", "n_name", "n_nationkey")).otherwise(_f("   n%", "n_nationkey"))
    docs = _nations(spark, d, entry, "Title\n=====\n\n.. toctree::\n   :caption: All\n\n", "\n", "\n\nEnd\n")
    return D.toctree_edges(docs, "source").select("src", "caption", "title", "dst")


@query(f"""SELECT {_SRC}, '/docs/' || n_name AS route, CAST(1000 + n_nationkey AS VARCHAR) AS module, '@site/' || n_name || '.mdx' AS made_from,
'js/' || CASE WHEN n_nationkey % 3 = 0 THEN 'deadbeef' || CAST(n_nationkey AS VARCHAR) ELSE CAST(100 + n_nationkey AS VARCHAR) END || '.' || CASE WHEN n_nationkey % 2 = 0 THEN 'h' || CAST(n_nationkey AS VARCHAR) ELSE CAST(100 + n_nationkey AS VARCHAR) END || '.js' AS file
FROM nation WHERE n_nationkey % 3 = 0 OR n_nationkey % 2 = 0""")
def bundle_routes(spark, d):
    """Main and runtime scripts of a bundler for each region; names that look like hashes, chunks without a name or a hash."""
    k = "n_nationkey"
    chunk = (F.col(k) + 100).cast("string")
    main = _f('path:"/docs/%",component:p("@layout","c%"),"/docs/%-c%":{"args":"x","content":"t%"},"t%":[()=>Promise.all([n.e(9),n.e(%)]).then(n.bind(n,%)),"@site/%.mdx",%]', "n_name", k, "n_name", k, k, k, chunk, F.col(k) + 1000, "n_name", k)
    mains = _nations(spark, d, main, "x={", ",", "}", name="script")
    own = _t(spark, d, "nation")
    names = _whole(own.filter(F.col(k) % 3 == 0), _f("r%", "n_regionkey"), k, _f('%:"deadbeef%"', chunk, k), "", ",", "", "names")
    hashes = _whole(own.filter(F.col(k) % 2 == 0), _f("r%", "n_regionkey"), k, _f('%:"h%"', chunk, k), "", ",", "", "hashes")
    both = names.join(hashes, "source", "full")
    script = _f('q.u=e=>"js/"+({%}[e]||e)+"."+({%}[e]||e)+".js",q.x=1', F.coalesce("names", F.lit("")), F.coalesce("hashes", F.lit("")))
    return D.route_contents(mains, both.select("source", script.alias("script")))


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def inflated_payloads(spark, d):
    """Texts as Base64 of zlib, as pages embed their specs."""
    @F.pandas_udf("string")
    def packed(values: pd.Series) -> pd.Series:
        return values.map(lambda t: b64encode(zlib.compress(t.encode())).decode(), na_action="ignore")

    return _t(spark, d, "documents").select("doc_id", T.content_hash(V.inflated(packed("text"))).alias("sha256"))


@query("""SELECT n_name AS url, '{"id": ' || CAST(n_nationkey AS VARCHAR) || ', "slug": "api"}' AS json FROM nation""")
def embedded_specs(spark, d):
    """JSON inside an attribute, the wanted object three levels down."""
    tree = _f('{"a":[{"slug":"other"},{"b":{"slug":"api","id":%}}]}', "n_nationkey")
    pages = _t(spark, d, "nation").select(F.col("n_name").alias("url"), _f('<div id="app" data-page="%"></div>', F.replace(tree, F.lit('"'), F.lit("&quot;"))).alias("html"))
    return D.embedded_object(pages, "slug", "api")


@query("SELECT n_name AS id, CAST(n_nationkey AS BIGINT) AS v FROM nation")
def directory_items(spark, d):
    """A directory that lists each name twice: the last counts."""
    twice = _nations(spark, d, _f('{"id":"%","v":-1},{"id":"%","v":%}', "n_name", "n_name", "n_nationkey"), '{"items":[', ",", "]}", name="json")
    return D.json_directory(twice, "id:string,v:bigint")


@query("SELECT doc_id FROM documents WHERE lang = 'en' AND doc_id % 3 > 0")
def validated_documents(spark, d):
    """Documents that parse and are of the wanted kind; every third is cut short."""
    body = F.to_json(F.struct(F.col("lang").alias("kind"), "source"))
    docs = _t(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.substring(body, 1, 5)).otherwise(body).alias("json"))
    return D.valid_documents(docs, "en").select("doc_id")


@query("SELECT 'd' || CAST(doc_id AS VARCHAR) AS url, CASE WHEN doc_id % 2 = 0 THEN source ELSE lang END AS title, lang AS description, sha256('f(' || source || ')') AS sha256 FROM documents")
def page_data_rows(spark, d):
    matter = F.struct(F.struct(F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("pageTitle"), F.struct(F.struct(F.col("lang").alias("title"), F.col("lang").alias("description")).alias("frontmatter"), _f("f(%)", "source").alias("compiledSource")).alias("source")).alias("pageProps"))
    rows = D.page_data(_t(spark, d, "documents").select(_f("d%", "doc_id").alias("url"), F.to_json(matter).alias("json")))
    return rows.select("url", "title", "description", T.content_hash("script").alias("sha256"))


@query("SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-02 00:00:00' - INTERVAL 12 HOUR")
def fresh_rows(spark, d):
    return D.fresh(_t(spark, d, "events"), 12, "ts", F.lit("2024-01-02 00:00:00").cast("timestamp")).select("event_id")


@query(f"SELECT {_SRC}, min(n_nationkey) AS ord FROM nation WHERE n_nationkey % 3 > 0 GROUP BY n_regionkey")
def fallback_chain(spark, d):
    """Of a chain of candidates the first that is a description: markup and cut JSON are passed over."""
    body = F.when(F.col("n_nationkey") % 3 == 0, F.lit("<!doctype html>")).when(F.col("n_nationkey") % 3 == 1, F.lit('{"paths": {}}')).otherwise(F.lit("[]"))
    return D.first_valid(_t(spark, d, "nation").select(_f("r%", "n_regionkey").alias("source"), F.col("n_nationkey").alias("ord"), body.alias("json"))).select("source", "ord")


@query("SELECT 'D' || CAST(doc_id AS VARCHAR) AS title, doc_id AS revision, sha256(text) AS sha256, lang || ',' || source AS categories FROM documents WHERE text IS NOT NULL")
def wiki_replies(spark, d):
    """Each document's page in two replies: its text, and, as a continuation, its categories."""
    docs, title = _t(spark, d, "documents"), _f("D%", "doc_id").alias("title")
    revision = F.array(F.struct(F.col("doc_id").alias("revid"), F.struct(F.struct(F.col("text").alias("content")).alias("main")).alias("slots")))
    reply = lambda page: F.to_json(F.struct(F.struct(F.array(page).alias("pages")).alias("query")))
    names = F.array(*[F.struct(_f("Category:%", c).alias("title")) for c in ("source", "lang")])
    both = docs.select(F.col("doc_id").alias("batch"), reply(F.struct(title, revision.alias("revisions"))).alias("json")).unionByName(docs.select(F.col("doc_id").alias("batch"), reply(F.struct(title, names.alias("categories"))).alias("json")))
    return D.wiki_pages(both)[0].select("title", "revision", T.content_hash("content").alias("sha256"), F.array_join("categories", ",").alias("categories"))


@query("SELECT source, page, n FROM (SELECT source, CAST(ceil(count(*) / 20.0) AS INTEGER) AS pages FROM documents GROUP BY 1), LATERAL (SELECT unnest(generate_series(1, pages)) AS page), LATERAL (SELECT 'b' || CAST(page AS VARCHAR) AS n)".replace("page, n FROM", "CAST(page AS INTEGER) AS page, n AS body FROM"))
def cursor_replies(spark, d):
    """Replies that name the next one, followed to their ends for all sources at once."""
    sizes = _t(spark, d, "documents").groupBy("source").agg(F.ceil(F.count("*") / 20).cast("int").alias("pages"))
    site = sizes.select("source", "pages", F.explode(F.sequence(F.lit(1), "pages")).alias("page"))
    reply = F.to_json(F.struct(_f("b%", "page").alias("body"), F.when(F.col("page") < F.col("pages"), _f("%/%", "source", F.col("page") + 1)).alias("next")))
    site = cut_here(site.select(_f("%/%", "source", "page").alias("url"), reply.alias("body"), F.lit(None).cast("string").alias("etag")))
    text = F.col("body").cast("string")
    found = W.landed_cursor_pages(sizes.select("source", _f("%/1", "source").alias("url")), site, run.landed(site), lambda p: p.select("source", F.get_json_object(text, "$.next").alias("url")))
    return found.select("source", "page", F.get_json_object(text, "$.body").alias("body"))


@query("""WITH RECURSIVE n AS (SELECT max(page_id) AS top FROM pages), w AS (SELECT CAST(0 AS BIGINT) AS id, 0 AS depth, '0' AS place UNION ALL
SELECT 2 * id + k, depth + 1, place || ',' || CAST(k AS VARCHAR) FROM w, n, (VALUES (1), (2)) v(k) WHERE 2 * id + k <= top)
SELECT 'p' || CAST(id AS VARCHAR) AS url, depth, place, CASE WHEN id % 2 = 0 THEN 304 ELSE 200 END AS status FROM w""")
def crawl_order(spark, d):
    """A site of the pages as a binary tree with links back to the root: depth and order at first sight; even pages are known and say 304."""
    pages = _t(spark, d, "pages").select("page_id")
    top = pages.agg(F.max("page_id")).first()[0]
    child = lambda k: F.when(2 * F.col("page_id") + k <= top, _f(' <a href="p%">', 2 * F.col("page_id") + k)).otherwise(F.lit(""))
    site = cut_here(pages.select(_f("p%", "page_id").alias("url"), F.concat(F.lit('<a href="p0">'), child(1), child(2)).alias("body"), _f("e%", "page_id").alias("etag"), "page_id"))
    known = site.filter("page_id % 2 = 0").select("url", "etag", F.col("body").cast("binary").alias("body"))

    def links(found):
        return found.select("url", F.posexplode(F.regexp_extract_all(F.col("body").cast("string"), F.lit('href="([^"]+)"'), F.lit(1))).alias("ord", "target"))

    roots = spark.createDataFrame([("p0", 0)], "url string, ord int")
    return W.crawl(roots, run.landed(site.drop("page_id")), links, known).select("url", "depth", F.array_join(F.transform("place", lambda x: x.cast("string")), ",").alias("place"), "status")


# ------------------------------------------------------------------ keys, filters, metadata


@query(r"""SELECT page_id, regexp_replace(regexp_replace(p, '[^\w./-]+', '-', 'g'), '^$', 'index') || '.md' AS path FROM (SELECT page_id, trim(regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*', ''), '[?#].*$', ''), '/') AS p FROM pages)""")
def output_paths(spark, d):
    return _t(spark, d, "pages").select("page_id", K.output_path(K.url_path("url")).alias("path"))


@query("SELECT doc_id FROM documents WHERE lang NOT IN ('fr', 'de')")
def untranslated_titles(spark, d):
    titles = _t(spark, d, "documents").select("doc_id", F.concat(F.lit("Page (x)"), F.when(F.col("lang") == "fr", F.lit(" (Français)")).when(F.col("lang") == "de", F.lit(" (Deutsch)")).otherwise(F.lit(""))).alias("title"))
    return titles.filter(~K.translated_title("title", ["Français", "Deutsch"])).select("doc_id")


@query(r"SELECT page_id FROM pages WHERE NOT regexp_matches(url, '[?&]ref=')")
def without_parameter(spark, d):
    return _t(spark, d, "pages").filter(~P.has_parameter("url", "ref")).select("page_id")


@query("SELECT 'https://h.test/docs/' || lang || '/' || CAST(doc_id AS VARCHAR) || '/' AS url FROM documents WHERE lang NOT IN ('fr', 'de')")
def english_only(spark, d):
    """Locales are told from the paths themselves: 'fr' and 'de' also stand bare, the others do not."""
    urls = _t(spark, d, "documents").select(_f("https://h.test/docs/%/%/", "lang", "doc_id").alias("url"))
    bare = spark.createDataFrame([(f"https://h.test/docs/{x}/",) for x in ("fr", "de")], "url string")
    return D.english_paths(urls.unionByName(bare), "/docs/")


@query(r"SELECT page_id FROM pages WHERE NOT regexp_matches(url, '/fr/\d*5') AND NOT regexp_matches(url, 'page=[13]')")
def excluded_by_pattern(spark, d):
    return _t(spark, d, "pages").filter(P.matches_none("url", [r"/fr/\d*5", "page=[13]"])).select("page_id")


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0")
def kept_categories(spark, d):
    name = F.when(F.col("doc_id") % 3 == 1, F.lit("Pages with broken links")).when(F.col("doc_id") % 3 == 2, F.lit("Kernel (Deutsch)")).otherwise(F.lit("Kernel"))
    return _t(spark, d, "documents").filter(~P.housekeeping_category(name, languages=["Deutsch"])).select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id % 4 IN (0, 3)")
def published_only(spark, d):
    flag = F.when(F.col("doc_id") % 4 == 1, F.lit("True")).when(F.col("doc_id") % 4 == 2, F.lit("yes")).when(F.col("doc_id") % 4 == 3, F.lit("false"))
    return _t(spark, d, "documents").filter(P.published(flag)).select("doc_id")


@query("SELECT turn, conv_id FROM conversations WHERE length(trim(text)) >= 50")
def long_enough_bodies(spark, d):
    return _t(spark, d, "conversations").filter(P.long_enough(F.concat(F.lit(" \n"), F.trim("text"), F.lit("\t ")))).select("turn", "conv_id")


@query("SELECT page_id FROM pages WHERE page_id % 2 = 1")
def scripts_only(spark, d):
    body = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("\n "), F.regexp_replace("html", "(?i)^.*?(<html)", "$1"))).otherwise(F.lit("var a = '<html>'"))
    return _t(spark, d, "pages").filter(~P.is_markup_page(body)).select("page_id")


@query("SELECT source, count(*) >= 30 AS ok FROM documents GROUP BY 1")
def least_rows_gate(spark, d):
    """Whether each source yields as many rows as it must for anything to be changed."""
    rows = _t(spark, d, "documents").select(F.col("source").alias("scope"))
    declared = rows.distinct().select("scope", F.lit(True).alias("complete"), F.lit(30).alias("least_rows"))
    return S.scope_gates(rows, declared).select(F.col("scope").alias("source"), F.col("open").alias("ok"))


@query("SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'Cheap' ELSE upper(p_type[1]) || lower(p_type[2:]) END AS kind, upper(p_name[1]) || p_name[2:instr(p_name, ' ')] || CASE split_part(p_name, ' ', 2) WHEN 'ring' THEN 'RING' ELSE upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] END AS title FROM part")
def display_names(spark, d):
    return _t(spark, d, "part").select("p_partkey", K.looked_up("p_type", {"ECONOMY": "Cheap"}).alias("kind"), K.derive_title(F.replace("p_name", F.lit(" "), F.lit("_")), ["ring"]).alias("title"))


@query("SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_size ORDER BY lower(n), n, p_partkey) AS INTEGER) AS place FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS n FROM part)")
def case_folded_order(spark, d):
    from pyspark.sql import Window

    rows = _t(spark, d, "part").select("p_partkey", "p_size", F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("n"))
    return rows.select("p_partkey", F.row_number().over(Window.partitionBy("p_size").orderBy(*R.folded_order("n"), "p_partkey")).alias("place"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100")
def limited_rows(spark, d):
    return R.limited(_t(spark, d, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 100)


@query("SELECT source, CASE WHEN n > 3 THEN array_to_string(l[1:3], '; ') || '; ... and ' || CAST(n - 3 AS VARCHAR) || ' more' ELSE array_to_string(l, '; ') END AS shown FROM (SELECT 'r' || CAST(n_regionkey AS VARCHAR) AS source, list(n_name ORDER BY n_nationkey) AS l, count(*) AS n FROM nation WHERE n_nationkey < 17 GROUP BY 1)")
def capped_display(spark, d):
    lists = _whole(_t(spark, d, "nation").filter("n_nationkey < 17"), _f("r%", "n_regionkey"), "n_nationkey", F.col("n_name"))
    return lists.select("source", F.array_join(R.shown(F.split("text", "\n"), 3), "; ").alias("shown"))


@query("SELECT source, array_to_string(list(lang ORDER BY first), ',') AS langs FROM (SELECT source, lang, min(doc_id) AS first FROM documents GROUP BY 1, 2) GROUP BY 1")
def seen_order(spark, d):
    return R.seen_values(_t(spark, d, "documents"), "source", "lang", "doc_id").select("source", F.array_join("values", ",").alias("langs"))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'Other' ELSE 'Q' || CAST(l.quality AS VARCHAR) END AS section FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def index_with_rest(spark, d):
    """Labels as an index of the documents, with a row for a page that is not there; the rest in a group of its own."""
    index = _t(spark, d, "labels").select("doc_id", _f("Q%", "quality").alias("section")).unionByName(spark.createDataFrame([(-5, "Q9")], "doc_id long, section string"))
    return C.with_rest(index, _t(spark, d, "documents").select("doc_id"), "doc_id").select("doc_id", "section")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'd' || CAST(doc_id AS VARCHAR) WHEN doc_id % 3 = 1 THEN 'd' || CAST(doc_id AS VARCHAR) || '/overview' ELSE 'gone/overview' END AS url FROM documents")
def alias_remap(spark, d):
    docs = _t(spark, d, "documents")
    index = docs.select("doc_id", F.when(F.col("doc_id") % 3 < 2, _f("d%/overview", "doc_id")).otherwise(F.lit("gone/overview")).alias("url"))
    pages = docs.filter("doc_id % 3 < 2").select(F.when(F.col("doc_id") % 3 == 0, _f("d%", "doc_id")).otherwise(_f("d%/overview", "doc_id")).alias("url"))
    return R.remapped_aliases(index, pages)


@query("SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN doc_id % 2 = 0 THEN lang WHEN source <> 'src3' THEN source END AS owner FROM documents")
def recovered_metadata(spark, d):
    """Where a plan lacks a value, the page written by the run before has it."""
    docs = _t(spark, d, "documents").withColumn("key", F.col("doc_id").cast("string"))
    state = docs.filter("source <> 'src3'").select("key", _f("# T\n\nOwner: %\n", "source").alias("content"))
    planned = docs.select("key", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(F.lit("")).alias("owner"))
    return recovered(planned, state, "owner", r"(?m)^Owner: (.+)$")


@query("SELECT 'a' || CAST(n_regionkey AS VARCHAR) AS api, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS ord, n_name AS spec FROM nation")
def api_version_tasks(spark, d):
    index = _whole(_t(spark, d, "nation"), _f("a%", "n_regionkey"), "n_nationkey", F.col("n_name"))
    return version_tasks(index.select(F.col("source").alias("api"), F.split("text", "\n").alias("specs")))


@query("SELECT source, n_name AS name, CASE WHEN r_regionkey % 2 = 0 THEN 'https://h.test/a/' || n_name ELSE 'https://x.test/q' END AS url FROM (SELECT 'r' || CAST(n_regionkey AS VARCHAR) AS source, n_name, n_nationkey AS r_regionkey FROM nation)")
def absolute_links(spark, d):
    href = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.lit("//x.test/q"))
    return _t(spark, d, "nation").select(_f("r%", "n_regionkey").alias("source"), F.col("n_name").alias("name"), K.absolute_link(href, F.lit("https://h.test/a/b?x")).alias("url"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN CAST(doc_id AS VARCHAR) || '.md' ELSE '../' || lang || '/' || CAST(doc_id AS VARCHAR) || '.md' END AS link FROM documents")
def relative_links(spark, d):
    return _t(spark, d, "documents").select("doc_id", K.relative_link(F.lit("docs/en/index.md"), _f("docs/%/%.md", "lang", "doc_id")).alias("link"))


@query("SELECT doc_id, CASE WHEN lang = 'fr' AND doc_id % 2 = 0 THEN 'deep' ELSE 'wide' END AS scope FROM documents WHERE lang IN ('fr', 'en')")
def longest_prefix(spark, d):
    """Paths with the scope of their longest prefix, by whole segments."""
    scopes = spark.createDataFrame([("fr", "wide"), ("fr/0", "deep"), ("en", "wide"), ("e", "none"), ("de/0/x", "none")], "prefix string, scope string")
    rows = _t(spark, d, "documents").select("doc_id", _f("%/%/%", "lang", F.col("doc_id") % 2, "source").alias("path"))
    return R.prefix_join(rows, scopes).select("doc_id", "scope")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'none' ELSE 'q' || CAST(l.quality AS VARCHAR) END AS content FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def content_lookup(spark, d):
    """An index whose pages' contents are looked up, some of them twice and some not at all."""
    labels = _t(spark, d, "labels").select("doc_id", _f("q%", "quality").alias("content"))
    return R.looked_up_content(_t(spark, d, "documents").select("doc_id"), labels.unionByName(labels), "doc_id", default="none")


@query(r"SELECT doc_id, CASE WHEN lang = 'en' THEN 'guides' WHEN lang = 'fr' THEN 'api-' || regexp_extract(source, '(\d+)$', 1) ELSE 'general' END AS category FROM documents")
def path_classes(spark, d):
    path = F.when(F.col("lang") == "en", _f("docs/guide-%", "source")).when(F.col("lang") == "fr", _f("reference/v%/x", F.regexp_extract("source", r"(\d+)$", 1))).otherwise(F.col("source"))
    return _t(spark, d, "documents").select("doc_id", K.classified(path, [(r"^docs/guide", "guides"), (r"^reference/v(\d+)", "api-$1")]).alias("category"))


class _Unsteady:
    """A transport that fails a number of times for each row, then answers; with redirects and known validators.

    How often it was asked for a row is told by the pauses between: a request without one before it is a row's first. So a row
    is answered the same way in whatever task, however often that runs.
    """

    def __init__(self):
        self.tries, self.paused = 0, False

    def pause(self, seconds: float) -> None:
        self.paused = True

    def __call__(self, url: str, headers: dict[str, str]) -> N.Reply:
        self.tries, self.paused = self.tries + 1 if self.paused else 1, False
        kind, fails = url.rsplit("/", 1)[1].split("-")[:2]
        if self.tries <= int(fails):
            return N.Reply(503, headers={"retry-after": "0"})
        if kind == "away":
            return N.Reply(302, headers={"location": "https://elsewhere.test/x"})
        if kind == "moved":
            return N.Reply(301, headers={"location": f"/found-0-{url.rsplit('-', 1)[1]}"})
        if headers.get("If-None-Match") == "known":
            return N.Reply(304)
        return N.Reply(200, url.encode(), {"etag": "known"})


@query("""SELECT policy, n_name, least(fails, tries) + 1 AS attempts, CASE WHEN fails > tries THEN 503 WHEN kind = 'away' THEN CASE WHEN policy = 'schedule' THEN 404 ELSE 302 END WHEN kind = 'moved' THEN CASE WHEN policy = 'schedule' THEN 200 ELSE 301 END WHEN kind = 'known' THEN 304 ELSE 200 END AS status
FROM (SELECT n_name, n_nationkey % 5 AS fails, CASE n_nationkey % 4 WHEN 0 THEN 'found' WHEN 1 THEN 'away' WHEN 2 THEN 'moved' ELSE 'known' END AS kind FROM nation), (VALUES ('once', 0), ('linear', 2), ('schedule', 4), ('budget', 3)) v(policy, tries)""")
def fetch_policies(spark, d):
    """The same unsteady site under each policy: tries, redirects on and off the host, validators."""
    k = F.col("n_nationkey")
    kind = F.when(k % 4 == 0, "found").when(k % 4 == 1, "away").when(k % 4 == 2, "moved").otherwise("known")
    asked = _t(spark, d, "nation").select("n_name", _f("https://u.test/%-%-%", kind, k % 5, "n_name").alias("url"), F.when(kind == "known", F.lit("known")).alias("etag"))
    out = None
    for policy in N.POLICIES:
        site = _Unsteady()
        got = N.fetch_all(asked, site, policy, etag="etag", sleep=site.pause).select(F.col("url").alias("u"), "status", "attempts")
        part = asked.join(got, F.col("url") == F.col("u")).select(F.lit(policy).alias("policy"), "n_name", "attempts", "status")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ texts and converters


@query("SELECT page_id, 'Page ' || CAST(page_id AS VARCHAR) || ' & more' AS heading, 'kept' AS body FROM pages")
def headings_and_banners(spark, d):
    rows = _t(spark, d, "pages").select("page_id", _f('<h1 class="x">Page <em>%</em> &amp;\n more</h1>', "page_id").alias("html"))
    return rows.select("page_id", T.html_heading("html").alias("heading"), T.stripped(T.without_banners(F.lit("> **Note**: old\n> x\n\nkept\n\nFeedback? Tell us.\n"), [r"(?m)^>.*\n?", r"(?m)^Feedback\?.*$"])).alias("body"))


@query("SELECT p_partkey, '``' || p_name || ' ` x``' AS span, '````js' || chr(10) || '```' || chr(10) || p_name || chr(10) || '````' AS block FROM part")
def code_fences(spark, d):
    return _t(spark, d, "part").select("p_partkey", T.code_span(_f("% ` x", "p_name")).alias("span"), T.fenced(_f("```\n%\n\n", "p_name"), F.lit("js")).alias("block"))


@query("SELECT p_partkey, p_name || ' ' || p_type AS collapsed, p_name AS stripped FROM part")
def white_space(spark, d):
    return _t(spark, d, "part").select("p_partkey", T.collapsed(_f(" %\t\n  %\n", "p_name", "p_type")).alias("collapsed"), T.stripped(_f(" \n%\t", "p_name")).alias("stripped"))


def _page(root: str) -> Column:
    """A page of one root with a heading, marks, a link, a list and code, by nation."""
    return _f(f'<html><head><title>% | Site</title></head><body><nav><a href="/n">nav</a></nav>{root}<h2>%</h2><p>Key <strong>%</strong> of <a href="/r/%">one</a>.</p><ul><li>x</li><li>y</li></ul><pre><code>a  b</code></pre></END></body></html>', "n_name", "n_name", "n_nationkey", "n_regionkey")


_BODY = "'## ' || n_name || chr(10) || chr(10) || 'Key **' || CAST(n_nationkey AS VARCHAR) || '** of [one](https://h.test/r/' || CAST(n_regionkey AS VARCHAR) || ').' || chr(10) || chr(10) || '- x' || chr(10) || '- y' || chr(10) || chr(10) || '```' || chr(10) || 'a  b' || chr(10) || '```' || chr(10)"
_ROOTS = {"plain": "main", "devsite": 'div class="devsite-article-body"', "readme": 'div class="rm-Article"', "docusaurus": "article", "asciidoc": 'div id="content"', "dita": 'div id="mc-main-content"', "docbook": 'div class="chapter"', "wiki": 'div class="wiki-content"', "jekyll": 'section class="text-content"'}


@query(f"SELECT dialect, n_name, '# T' || chr(10) || chr(10) || {_BODY} AS markdown FROM nation, (VALUES {', '.join(f'({chr(39)}{x}{chr(39)})' for x in _ROOTS)}) v(dialect)")
def html_dialects(spark, d):
    """The same page in the frame of each dialect."""
    out = None
    for dialect, root in _ROOTS.items():
        html = F.replace(_page(f"<{root}>"), F.lit("</END>"), F.lit(f"</{root.split()[0]}>"))
        part = _t(spark, d, "nation").select(F.lit(dialect).alias("dialect"), "n_name", V.html_to_markdown(html, dialect, F.lit("https://h.test/a/b"), F.lit("T")).alias("markdown"))
        out = part if out is None else out.unionByName(part)
    assert set(_ROOTS) == set(html_md.DIALECTS)
    return out


@query("SELECT n_name, CAST(0 AS INTEGER) AS ord, n_name AS title, 'One' || chr(10) AS markdown FROM nation UNION ALL SELECT n_name, 1, 'Part ' || CAST(n_nationkey AS VARCHAR), 'Two **b**' || chr(10) FROM nation")
def html_sectioned(spark, d):
    html = _f("<h1>%</h1><p>One</p><h2 id='p'>Part %</h2><p>Two <b>b</b></p>", "n_name", "n_nationkey")
    return _t(spark, d, "nation").select("n_name", F.explode(V.html_sections(html)).alias("s")).select("n_name", "s.ord", "s.title", "s.markdown")


@query("SELECT n_name, '> [!NOTE]' || chr(10) || '> ' || n_name || chr(10) || chr(10) || 'plain `x`' || chr(10) AS mdx, '> [!NOTE]' || chr(10) || '> ' || n_name || chr(10) AS hugo, '**' || n_name || '**' || chr(10) || chr(10) || 'body' || chr(10) || chr(10) || '> [!NOTE]' || chr(10) || '> **Hey**' || chr(10) || '> inner' || chr(10) AS mkdocs, '> [!TIP]' || chr(10) || n_name || chr(10) AS asides FROM nation")
def component_markdown(spark, d):
    """Components, shortcodes, tabs and admonitions, and asides."""
    return _t(spark, d, "nation").select(
        "n_name", V.mdx_to_markdown(_f("import X from './x'\n\n<Note>\n%\n</Note>\n\nplain `x`\n", "n_name")).alias("mdx"), V.shortcodes_to_markdown(_f('{{< callout context="note" >}}\n%\n{{< /callout >}}\n', "n_name")).alias("hugo"),
        V.mkdocs_to_markdown(_f('=== "%"\n\n    body\n\n!!! note "Hey"\n    inner\n', "n_name")).alias("mkdocs"), T.renamed_asides(_f(":::tip\n%\n:::", "n_name"), {"tip": "TIP"}).alias("asides"))


@query("SELECT n_name, '## ' || n_name || chr(10) || chr(10) || '> **Note:** be careful' || chr(10) || chr(10) || '**b** [label](https://wiki.archlinux.org/title/' || n_name || ') [y](https://x.test)' || chr(10) || '- a' || chr(10) || '- b' || chr(10) AS wiki FROM nation")
def wiki_markdown(spark, d):
    return _t(spark, d, "nation").select("n_name", V.wikitext_to_markdown(_f("== % ==\n{{Note|be careful}}\n'''b''' [[%|label]] [https://x.test y]\n* a\n* b\n", "n_name", "n_name")).alias("wiki"))


@query("SELECT 'n' || CAST(a.n_nationkey AS VARCHAR) AS name, '# ' || a.n_name || chr(10) || chr(10) || 'Text `c` and [' || b.n_name || '](n' || CAST(b.n_nationkey AS VARCHAR) || '.md#' || lower(b.n_name) || ').' || chr(10) || chr(10) || '> [!NOTE]' || chr(10) || '> hey' || chr(10) AS markdown FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey + 1) % 25")
def rst_corpus(spark, d):
    """Documents of a corpus that refer to the label of the next one."""
    rst = _f(".. _l%:\n\n%\n==========\n\nText ``c`` and :ref:`l%`.\n\n.. note:: hey\n", "n_nationkey", "n_name", (F.col("n_nationkey") + 1) % 25)
    return V.rst_to_markdown(_t(spark, d, "nation").select(_f("n%", "n_nationkey").alias("name"), rst.alias("text"))).select("name", "markdown")


@query("""SELECT n_name, '{' || chr(10) || '  "a": ' || CAST(n_nationkey AS VARCHAR) || ',' || chr(10) || '  "b": "' || n_name || '"' || chr(10) || '}' AS canonical, CASE WHEN n_nationkey % 2 = 0 THEN '{"slug": "same", "v": ' || CAST(n_nationkey AS VARCHAR) || '}' END AS found, 'See [X](/x)' || chr(10) || 'on ' || n_name AS clean, 'See [X](/x) on ' || n_name || ' \\| y' AS cell FROM nation""".replace("\\\\|", "\\|"))
def json_and_descriptions(spark, d):
    """Canonical JSON; the first of two objects with a wanted field, three levels down, where there is one; descriptions."""
    tree = _f('{"b":"%","a":%}', "n_name", "n_nationkey")
    slug = F.when(F.col("n_nationkey") % 2 == 0, "same").otherwise("else")
    nested = _f('{"slug":"not","p":[{"slug":"x%"},{"q":{"v":%,"slug":"%"}},{"slug":"%","v":-1}]}', "n_name", "n_nationkey", slug, slug)
    return _t(spark, d, "nation").select(
        "n_name", V.canonical_json(tree).alias("canonical"), V.found_object(nested, "slug", "same").alias("found"), V.clean_description(_f('<p>See <a href="/x">X</a><br>on %</p>', "n_name")).alias("clean"),
        V.clean_description(_f('<p>See <a href="/x">X</a> on % | y</p>', "n_name"), inline=True).alias("cell"))


# ------------------------------------------------------------------ descriptions that differ by row

_NL = "chr(10)"


def _spec() -> Column:
    """A description for each nation: references, a joined enum, choices, nested arrays, parameters, body, responses, security."""
    return _f(
        '{"openapi":"3.0.0","servers":[{"url":"https://{r}.api.test/v%","variables":{"r":{"default":"eu"}}}],"security":[{"oauth":["read"]}],"components":{"schemas":{"Kind":{"type":"string","enum":["%","z"]},"Item":{"type":"object","required":["id"],"properties":{"id":{"type":"integer","format":"int%"},"next":{"$ref":"#/components/schemas/Item"}}}}},'
        '"paths":{"/%/{id}":{"parameters":[{"name":"id","in":"path","required":true,"schema":{"type":"string"},"description":"of %"}],"put":{"summary":"Put %","operationId":"put%","tags":["T%"],"requestBody":{"required":true,"content":{"application/json":{"schema":{"$ref":"#/components/schemas/Item"}}}},"responses":{"200":{"description":"OK %"},"404":{"description":"None"}}}}}}',
        "n_regionkey", "n_name", "n_nationkey", "n_name", "n_name", "n_name", "n_nationkey", "n_regionkey", "n_nationkey")


@query("""SELECT n_name, 'string - enum: `' || n_name || '`, `z`' AS joined, 'Any of: string - enum: `' || n_name || '`, `z` | null' AS choice, 'array of array of object' || chr(10) || '- `id` (integer (int' || CAST(n_nationkey AS VARCHAR) || ')) **required**' || chr(10) || '- `next` (`Item` (circular reference))' AS nested FROM nation""")
def schema_texts(spark, d):
    spec, kind, item = _spec(), '{"$ref":"#/components/schemas/Kind"}', '{"$ref":"#/components/schemas/Item"}'
    text = lambda s: V.schema_type_text(F.lit(s), spec)
    return _t(spark, d, "nation").select("n_name", text(f'{{"allOf":[{kind}],"description":"d"}}').alias("joined"), text(f'{{"anyOf":[{{"allOf":[{kind}]}},{{"type":"null"}}]}}').alias("choice"), text(f'{{"type":"array","items":{{"type":"array","items":{item}}}}}').alias("nested"))


@query(f"""SELECT n_name AS source, 'put' AS method, 'T' || CAST(n_regionkey AS VARCHAR) AS tag, 'put-' || replace(lower(n_name), '_', '-') || '-id.md' AS file,
array_to_string(['# Put ' || n_name, '', '```', 'PUT /' || n_name || '/{{id}}', '```', '', '**Base URL:** `https://eu.api.test/v' || CAST(n_regionkey AS VARCHAR) || '`', '', '**Operation ID:** `put' || CAST(n_nationkey AS VARCHAR) || '`', '',
'**Tags:** T' || CAST(n_regionkey AS VARCHAR), '', '**Security:** `oauth` (read)', '', '### Parameters', '', '| Name | In | Type | Required | Description |', '|------|-----|------|----------|-------------|', '| `id` | path | string | Yes | of ' || n_name || ' |', '',
'### Request Body', '', '**Required:** Yes', '', '**Content-Type:** `application/json`', '', 'object', '- `id` (integer (int' || CAST(n_nationkey AS VARCHAR) || ')) **required**', '- `next` (`Item` (circular reference))', '',
'### Responses', '', '#### 200', '', 'OK ' || CAST(n_nationkey AS VARCHAR), '', '#### 404', '', 'None', ''], {_NL}) AS markdown FROM nation""")
def endpoint_pages(spark, d):
    specs = _t(spark, d, "nation").select(F.col("n_name").alias("source"), _spec().alias("spec"))
    return V.endpoint_documents(specs).select("source", "method", "tag", "file", "markdown")


@query("SELECT n_name AS source, '/' || n_name || '/{id}' AS path, 'put' AS method, 'T' || CAST(n_regionkey AS VARCHAR) AS tag, 'Put ' || n_name AS summary FROM nation")
def endpoints_by_row(spark, d):
    return V.exploded_endpoints(_t(spark, d, "nation").select(F.col("n_name").alias("source"), _spec().alias("spec")))


@query("SELECT n_name, CASE n_nationkey % 5 WHEN 0 THEN 'openapi' WHEN 1 THEN 'swagger' WHEN 2 THEN 'postman' WHEN 3 THEN 'vendor' ELSE 'unknown' END AS format FROM nation")
def spec_formats(spark, d):
    k = F.col("n_nationkey") % 5
    body = F.when(k == 0, _spec()).when(k == 1, F.lit('{"swagger":"2.0","paths":{}}')).when(k == 2, F.lit('{"info":{"schema":"https://schema.getpostman.com/x"},"item":[]}')).when(k == 3, F.lit('{"apiList":[],"content":{}}')).otherwise(F.lit("3"))
    return _t(spark, d, "nation").select("n_name", V.spec_format(body).alias("format"))


@query("SELECT 'r' || CAST(n_regionkey AS VARCHAR) AS source, 'F' || CAST(n_regionkey AS VARCHAR) AS folder, n_name AS name, 'POST' AS method, 'https://h.test/' || CAST(n_nationkey AS VARCHAR) || '?x=1' AS url, '# ' || n_name || chr(10) || chr(10) || '```' || chr(10) || 'POST https://h.test/' || CAST(n_nationkey AS VARCHAR) || '?x=1' || chr(10) || '```' || chr(10) || chr(10) || '| Name | Value | Description |' || chr(10) || '|------|-------|-------------|' || chr(10) || '| `x` | 1 |  |' || chr(10) AS markdown FROM nation")
def postman_requests(spark, d):
    item = _f('{"name":"%","request":{"method":"POST","url":{"raw":"https://h.test/%?x=1","query":[{"key":"x","value":"1"}]}}}', "n_name", "n_nationkey")
    inner = _nations(spark, d, item, "", ",", "")
    return V.postman_documents(inner.select("source", _f('{"item":[{"name":"F%","item":[%]}]}', F.substring("source", 2, 9), "text").alias("spec")))


@query("""SELECT n_name AS source, file, CASE file WHEN 'enums/e.md' THEN '# E' || chr(10) || chr(10) || '| Name | Value | Description |' || chr(10) || '|------|-------|-------------|' || chr(10) || '| `' || n_name || '` | ' || CAST(n_nationkey AS VARCHAR) || ' |  |' || chr(10)
WHEN 'requests/main.md' THEN '# main' || chr(10) || chr(10) || '## Go' || n_name || chr(10) || chr(10) || 'of ' || CAST(n_nationkey AS VARCHAR) || chr(10) ELSE '# Protocol' || chr(10) || chr(10) || '- [enums/e.md](enums/e.md)' || chr(10) || '- [requests/main.md](requests/main.md)' || chr(10) END AS markdown
FROM nation, (VALUES ('README.md'), ('enums/e.md'), ('requests/main.md')) v(file)""")
def protocol_files(spark, d):
    """All files of a protocol for each nation, with what stands in them."""
    spec = _f('{"enums":[{"enumType":"E","enumIdentifiers":[{"enumIdentifier":"%","enumValue":%}]}],"requests":[{"requestType":"Go%","category":"main","description":"of\\n%","requestFields":[]}],"events":[]}', "n_name", "n_nationkey", "n_name", "n_nationkey")
    return V.protocol_documents(_t(spark, d, "nation").select(F.col("n_name").alias("source"), spec.alias("spec")))


@query("""SELECT n_name, array_to_string(['p' || CAST(n_regionkey AS VARCHAR), 'own' || CAST(n_nationkey AS VARCHAR), 'scope:read', 'scope:w' || CAST(n_regionkey AS VARCHAR)], ',') AS policies, 'a b ' || n_name AS plain, CASE WHEN n_nationkey % 2 = 0 THEN 'from ' || n_name ELSE '' END AS held FROM nation""")
def operation_policies(spark, d):
    """Policies by name, by reference and by a reference to a list, scopes of the operation before those of the description; texts in objects."""
    spec = _f('{"security":[{"o":["all"]}],"x":{"list":["p%",{"$ref":"#/y/own%"}]},"paths":{"/%":{"get":{"x-policies":{"$ref":"#/x/list"},"security":[{"o":["read"]},{"o":["read","w%"]}]}}}}', "n_regionkey", "n_nationkey", "n_name", "n_regionkey")
    held = F.when(F.col("n_nationkey") % 2 == 0, _f('{"content":"from\\n %","type":"x"}', "n_name")).otherwise(F.lit('{"type":"x"}'))
    made = V.operation_policies(spec)
    return _t(spark, d, "nation").select("n_name", F.array_join(F.element_at(made, _f("GET /%", "n_name")), ",").alias("policies"), V.one_line(_f('"a\\n  b\\t%"', "n_name")).alias("plain"), V.one_line(held).alias("held"))


@query("""SELECT doc_id, '# ' || source || chr(10) || chr(10) || 'Text of **' || lang || '** and `' || lang || '`.' || chr(10) AS markdown, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS unknown FROM documents""")
def compiled_pages(spark, d):
    """Compiled components of each document as Markdown, and how often a component occurs that nothing is known of."""
    odd = F.when(F.col("doc_id") % 3 == 0, F.lit(',"\\n",_jsx(Odd,{})')).otherwise(F.lit(""))
    script = _f('function _createMdxContent(props){const _components={h1:"h1",p:"p",strong:"strong",code:"code",...props.components};return _jsxs(_Fragment,{children:[_jsx(_components.h1,{children:"%"}),"\\n",_jsxs(_components.p,{children:["Text of ",_jsx(_components.strong,{children:"%"})," and ",_jsx(_components.code,{children:"%"}),"."]})%]})}', "source", "lang", "lang", odd)
    made = V.compiled_to_markdown(script)
    return _t(spark, d, "documents").select("doc_id", made["markdown"].alias("markdown"), F.coalesce(F.try_element_at(made["unknown"], F.lit("Odd")), F.lit(0)).alias("unknown"))


@query("""SELECT doc_id, 'Held `*' || source || '* ' || lang || '_` and [' || lang || '](https://x.test/' || source || ') and *' || lang || '*.' || chr(10) AS markdown FROM documents""")
def held_spans(spark, d):
    """Spans that are taken out before the rest of a text is rewritten, and put back as they were."""
    text = _f("Held ``*%* %_`` and `% <https://x.test/%>`_ and `%`.\n", "source", "lang", "lang", "source", "lang")
    made = V.rst_to_markdown(_t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("name"), text.alias("text"), "doc_id"))
    return made.select("doc_id", "markdown")


# ------------------------------------------------------------------ sinks


def _root(spark, what: str) -> str:
    return own_path(spark, what)


def _exports(spark, d) -> tuple[DataFrame, DataFrame]:
    docs = _t(spark, d, "documents").select(_f("%/%.md", "lang", "doc_id").alias("key"), F.col("text").alias("content"), "lang", "doc_id")
    return docs, docs.withColumn("content", F.when(F.col("lang") == "fr", F.concat(F.coalesce("content", F.lit("")), F.lit("x"))).otherwise(F.col("content")))


@query("SELECT lang || '/' || CAST(doc_id AS VARCHAR) || '.md' AS path, CAST(octet_length(encode(coalesce(text, ''))) + CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS BIGINT) AS bytes, lang = 'fr' AS written FROM documents")
def changed_files(spark, d):
    """An export, and a second one after a change: only what differs is written."""
    where, (old, new) = _root(spark, "files"), _exports(spark, d)
    cut_here(export_markdown(old, where))
    return cut_here(export_markdown(new, where))


@query("SELECT lang || '/' || CAST(doc_id AS VARCHAR) || '.md' AS path, doc_id % 2 = 0 AS removed FROM documents WHERE lang <> 'en'")
def removed_files(spark, d):
    """Files of pages that are gone, some of which were never written."""
    where, (old, _) = _root(spark, "files"), _exports(spark, d)
    cut_here(export_markdown(old.filter("doc_id % 2 = 0"), where))
    return cut_here(remove_exported(old.filter("lang <> 'en'"), where))


@query("SELECT 'r' || CAST(n_regionkey AS VARCHAR) || '/' || sha256('{\"n\":' || CAST(n_nationkey % 10 AS VARCHAR) || '}') || '.json' AS path, CAST(7 AS BIGINT) AS bytes, n_nationkey % 10 >= 5 AS written FROM nation GROUP BY n_regionkey, n_nationkey % 10")
def raw_archive(spark, d):
    """Raw descriptions by their hash: what was archived by an earlier run, or comes twice, is written once."""
    where = _root(spark, "raw")
    raw = _t(spark, d, "nation").select(_f("r%", "n_regionkey").alias("source"), _f('{"n":%}', F.col("n_nationkey") % 10).alias("body"))
    cut_here(archive_raw(raw.filter(F.get_json_object("body", "$.n").cast("int") < 5), where))
    return cut_here(archive_raw(raw, where))


def _code_of(*modules) -> str:
    """The hash of modules' files, as their texts stand on disk."""
    return hashlib.sha256("\0".join(sorted(Path(m.__file__).read_text(encoding="utf-8") for m in modules)).encode()).hexdigest()


@query(f"SELECT doc_id, CAST(doc_id AS VARCHAR) AS own, '{_code_of(html_md)}' AS engine, '{_code_of(html_md, wiki_md)}' AS both FROM documents")
def engine_tokens(spark, d):
    """Change tokens with the hash of the converters' code before them; the same engine, whatever function of a module names it."""
    parts = lambda *f: F.split(T.versioned(F.col("doc_id").cast("string"), engine_of(*f)), "\u0001")
    one, two = parts(html_md.html_to_markdown, html_md.sections), parts(html_md.page_title, wiki_md.wikitext_to_markdown)
    return _t(spark, d, "documents").select("doc_id", one[1].alias("own"), one[0].alias("engine"), two[0].alias("both"))


@query("SELECT CASE WHEN source = 'src5' THEN 'deprecated/' ELSE '' END || CAST(doc_id AS VARCHAR) AS key, sha256(coalesce(text, '')) AS sha256 FROM documents")
def archived_pages(spark, d):
    """The state after a run that archives what is gone, and one more, which leaves the archive alone."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), F.coalesce("text", F.lit("")).alias("text"), "source")
    store = SnapshotStore(spark, _root(spark, "archive"))
    for site in (docs, kept := docs.filter("source <> 'src5'"), kept):
        bodies = site.select("key", F.lit(200).alias("status"), F.col("text").alias("body"))
        fetch = lambda wanted, bodies=bodies: bodies.join(wanted.select("key").hint("shuffle_hash"), "key", "left_semi")
        convert = lambda rows: rows.select("key", F.lit("").alias("title"), F.col("body").alias("content"))
        synchronise(site.select("key", T.content_hash("text").alias("token")), fetch, convert, store, Options(archive=True))
    return store.read().select("key", "sha256")


@query("""SELECT status, n FROM (SELECT CASE WHEN lang = 'fr' THEN 'updated' WHEN source = 'src5' THEN 'removed' WHEN source = 'src3' THEN 'added' ELSE 'unchanged' END AS s, * FROM documents), LATERAL (SELECT CASE WHEN source = 'src5' THEN 'removed' WHEN source = 'src3' THEN 'added' WHEN lang = 'fr' THEN 'updated' ELSE 'unchanged' END AS status), LATERAL (SELECT 1 AS one)
""".replace("SELECT status, n FROM", "SELECT status, count(*) AS n FROM").rstrip() + " GROUP BY 1")
def synchronised_corpus(spark, d):
    """Two runs from manifest to commit, the first in parts that commit each: what the second run adds, changes and removes."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), F.coalesce("text", F.lit("")).alias("text"), "lang", "source")
    old = docs.filter("source <> 'src3'")
    new = docs.filter("source <> 'src5'").withColumn("text", F.when(F.col("lang") == "fr", F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    store = SnapshotStore(spark, _root(spark, "sync"))

    def once(site: DataFrame, parts: int):
        bodies = site.select("key", F.lit(200).alias("status"), F.col("text").alias("body"))
        fetch = lambda wanted: bodies.join(wanted.select("key").hint("shuffle_hash"), "key", "left_semi")
        convert = lambda rows: rows.select("key", F.lit("").alias("title"), F.col("body").alias("content"))
        return synchronise_in_parts(site.select("key", T.content_hash("text").alias("token")), fetch, convert, store, Options(), parts)

    once(old, 2)
    before = cut_here(store.read().select("key", F.col("sha256").alias("old_sha")))
    once(new, 1)
    after = store.read().select("key", "sha256")
    return S.status_counts(S.classify(before.withColumnRenamed("old_sha", "sha256"), after))


# ------------------------------------------------------------------ sources, end to end


def _twice(spark, spec: SourceSpec, first: DataFrame, second: DataFrame) -> DataFrame:
    """(key, status) of a second run, after a first."""
    store = SnapshotStore(spark, _root(spark, f"source-{spec.name}"))
    run.run_source(spark, spec, store, run.landed(cut_here(first)))
    return run.run_source(spark, spec, store, run.landed(cut_here(second))).rows.select("key", "status")


def _site(index: Column | str, text: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(url, body, etag) of an index in one text, and of pages."""
    rows = text.select(F.lit(index).alias("url"), F.col("text").alias("body"), F.lit(None).cast("string").alias("etag"))
    return rows if pages is None else rows.unionByName(pages.withColumn("etag", F.lit(None).cast("string")))


_CHANGED = "CASE WHEN n_regionkey = 0 THEN 'added' WHEN n_regionkey = 3 THEN 'removed' WHEN n_regionkey = 1 THEN 'updated' ELSE 'unchanged' END AS status FROM nation"


def _states(spark, d, mark) -> tuple[DataFrame, DataFrame]:
    """Nations without region 0, then without region 3 and with region 1 changed."""
    rows = _t(spark, d, "nation").withColumn("mark", F.lit(""))
    return rows.filter("n_regionkey <> 0"), rows.filter("n_regionkey <> 3").withColumn("mark", F.when(F.col("n_regionkey") == 1, F.lit(mark)).otherwise(F.lit("")))


@query(f"SELECT 't' || CAST(n_regionkey AS VARCHAR) || '/get-' || replace(lower(n_name), '_', '-') || '.md' AS key, {_CHANGED}")
def source_of_descriptions(spark, d):
    """A source of one API description (fixed, abort on failure): an endpoint for each nation, run twice."""
    spec = SourceSpec("apis", "fixed", ("openapi",), "endpoint_documents", "https://a.test/openapi.json", failure="abort")
    text = lambda rows: _whole(rows, F.lit("x"), "n_nationkey", _f('"/%":{"get":{"summary":"Get %%","tags":["T%"]}}', "n_name", "n_name", "mark", "n_regionkey"), '{"openapi":"3.0.0","paths":{', ",", "}}")
    return _twice(spark, spec, *(_site(spec.url, text(rows)) for rows in _states(spark, d, "!")))


@query(f"SELECT 'docs/' || n_name || '.md' AS key, {_CHANGED}")
def source_of_sitemap(spark, d):
    """A source of a sitemap with dates (change tokens) and pages of the devsite dialect, run twice."""
    spec = SourceSpec("cloud", "sitemap_tree", ("html",), "html_to_markdown:devsite", "https://c.test/sitemap.xml", token="lastmod")
    spec = SourceSpec(**{**spec.__dict__, "url": "https://c.test"})
    entry = _f("<url><loc>https://c.test/docs/%</loc><lastmod>2024-01-01%</lastmod></url>", "n_name", "mark")
    page = lambda rows: rows.select(_f("https://c.test/docs/%", "n_name").alias("url"), _f('<title>% | C</title><div class="devsite-article-body"><p>Text%</p></div>', "n_name", "mark").alias("body"))
    return _twice(spark, spec, *(_site(spec.url, _whole(rows, F.lit("x"), "n_nationkey", entry, "<urlset>", "", "</urlset>"), page(rows)) for rows in _states(spark, d, "T1")))


@query(f"SELECT 'docs/' || n_name || '.md' AS key, {_CHANGED}")
def source_of_links(spark, d):
    """A source of an index of links and components in its pages, without change tokens: the content's hash tells, run twice."""
    spec = SourceSpec("mdx", "link_index", ("mdx",), "mdx_to_markdown", "https://m.test/docs/llms.txt")
    page = lambda rows: rows.select(_f("https://m.test/docs/%.md", "n_name").alias("url"), _f("# %\n\n<Note>\ntext%\n</Note>\n", "n_name", "mark").alias("body"))
    return _twice(spark, spec, *(_site(spec.url, _whole(rows, F.lit("x"), "n_nationkey", _f("- [%](%.md): about", "n_name", "n_name"), "# Index\n\n## Docs\n"), page(rows)) for rows in _states(spark, d, "!")))


@query(f"SELECT 'docs/' || n_name || '.md' AS key, {_CHANGED} UNION ALL SELECT 'docs.md', 'updated'")
def source_of_crawl(spark, d):
    """A source that is crawled from its first page along a chain of links, in the jekyll dialect, run twice."""
    spec = SourceSpec("crawl", "reachable", ("html",), "html_to_markdown:jekyll", "https://t.test/docs/", failure="abort", least_rows=3)
    link = _f('<a href="/docs/%">%</a>', "n_name", "n_name")
    frame = lambda inner: _f('<section class="text-content">%</section>', inner)
    page = lambda rows: rows.select(_f("https://t.test/docs/%", "n_name").alias("url"), frame(_f('<h1>%</h1><p>x%</p><a href="/docs/">up</a>', "n_name", "mark")).alias("body"))
    return _twice(spark, spec, *(_site(spec.url, _whole(rows, F.lit("x"), "n_nationkey", link).withColumn("text", frame(F.col("text"))), page(rows)) for rows in _states(spark, d, "!")))
