"""Running a source: its row of sources.registry resolved to discovery, converter, change token, failure rule and one plan.

A source has parts, joined by `+` in its row: each is a discovery with the address where it starts and the converter of what
it finds. Discoveries give rows (url, token, title, body, status, etag, scope): body and status where the page has come with
its index, null where it is still to be fetched. A path of the URL names the output. Everything that is fetched goes through
one function `get`, from (url, etag) to (url, status, body, etag), so that a run over landed pages is the same run.

What a run has not seen in full it does not remove. Each part, each shard of a sitemap and each description has a scope of
its own, whose gate opens only if it came in full and gave rows; a page that failed keeps its content, and a crawl with a
failed page closes its part, as what that page leads to was not seen. Of a key that several parts give, the first part counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import convert as V
from ..functions import keys as K
from ..functions import spec_md
from ..functions import text as T
from ..operators import catalogue as C
from ..operators import documents as P
from ..operators import graph as G
from ..operators import state as S
from ..sources import discover as D
from ..sources import requests as Q
from ..sources import transport
from ..sources.crawl import Get, crawl, cursor_pages
from ..sources.registry import SOURCES, SourceSpec
from .store import SnapshotStore, cut_here, reused
from .sync import ARCHIVE, STATE, Options, Outcome, SourceFailed, archive_raw, engine_of, made_by, synchronise, synchronise_in_parts

_ASKED = "url string, etag string"


def online(policy: str, headers: dict[str, str] | None = None, send: transport.Transport = transport.standard_transport) -> Get:
    """Fetch by a transport, under a policy, from tasks."""
    with_headers = (lambda url, own: send(url, {**(headers or {}), **own})) if headers else send
    return lambda asked: transport.fetch_all(asked, with_headers, policy, etag="etag")


def landed(site: DataFrame) -> Get:
    """Fetch from rows (url, body, etag) by an equi-join: 404 for what is not there, 304 where the etag is the one asked with.

    A column status says what a row answers with otherwise.
    """

    def get(asked: DataFrame) -> DataFrame:
        own = F.col("status") if "status" in site.columns else F.lit(200)
        there = site.select(F.col("url").alias("__u"), F.col("body").cast("binary").alias("__b"), F.col("etag").alias("__e"), own.alias("__s"))
        status = F.when(F.col("__u").isNull(), 404).when((F.col("__s") == 200) & F.col("etag").eqNullSafe(F.col("__e")) & F.col("__e").isNotNull(), 304).otherwise(F.col("__s"))
        joined = asked.join(there, F.col("url") == F.col("__u"), "left").withColumn("status", status)
        return joined.select("url", "status", F.when(F.col("status") == 200, F.col("__b")).alias("body"), F.col("__e").alias("etag"))

    return get


def probed(get: Get, head: Get) -> Get:
    """get behind a look at validators: what is known by an etag is asked for by head first, and only if that has another one by get."""

    def run(asked: DataFrame) -> DataFrame:
        asked = cut_here(asked)
        known = asked.filter("etag IS NOT NULL")
        told = head(known.select("url").distinct().withColumn("etag", F.lit(None).cast("string"))).filter("status = 200").select(F.col("url").alias("__h"), F.col("etag").alias("__now"))
        same = cut_here(known.join(told, (F.col("url") == F.col("__h")) & (F.col("etag") == F.col("__now"))).select("url", F.lit(304).alias("status"), F.lit(None).cast("binary").alias("body"), "etag"))
        rest = asked.join(same.select(F.col("url").alias("__same")), F.col("url") == F.col("__same"), "left_anti")
        return same.unionByName(get(rest).select("url", "status", F.col("body").cast("binary").alias("body"), "etag"))

    return run


@dataclass(frozen=True)
class Found:
    """What a discovery gives: rows, and (scope, complete) of the scopes that it tells apart; without any it has seen all."""

    rows: DataFrame
    gates: DataFrame | None = None
    settled: DataFrame | None = None  #: (provider, version, fingerprint, complete, current)


@dataclass(frozen=True)
class World:
    """What a discovery may use beside its index."""

    spec: SourceSpec
    start: str
    get: Get
    store: SnapshotStore
    engine: str = ""
    force: bool = False
    providers: tuple[str, ...] = ()

    def state(self) -> DataFrame:
        """Rows of the state that this engine made and that have their output; none, if all is to be made anew."""
        rows = self.store.read(STATE)
        return rows.limit(0) if self.force else rows.filter(made_by("token", self.engine) & F.coalesce("output_exists", F.lit(False)))


def _found(rows: DataFrame, url: Column, token: Column | None = None, title: Column | None = None, body: Column | None = None, status: Column | None = None, etag: Column | None = None, scope: Column | None = None, summary: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    text = lambda c: none if c is None else c.cast("string")
    told = F.when(body.isNotNull(), 200) if body is not None and status is None else F.lit(None) if status is None else status
    return rows.select(url.alias("url"), text(token).alias("token"), (F.lit("") if title is None else title).alias("title"), text(body).alias("body"), told.cast("int").alias("status"), text(etag).alias("etag"), (F.lit("") if scope is None else scope).alias("scope"), (F.lit("") if summary is None else summary).alias("summary"))


def _below(w: World, path: Column, suffix: str = "") -> Column:
    base = w.spec.raw_base or w.spec.url
    return F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(path, "^/+", ""), F.lit(suffix))


def _origin(url: str) -> str:
    return "/".join(url.split("/")[:3])


def _reached(index: DataFrame, w: World) -> Found:
    """All pages below the prefix that links lead to; what the run before has is asked for with its etag, and answered from its raw body."""
    origin, prefix = F.lit(w.start), w.spec.within or "/" + "/".join(w.start.split("/")[3:])
    root = prefix.rstrip("/")

    def links(pages: DataFrame) -> DataFrame:
        hrefs = F.regexp_extract_all(F.col("body").cast("string"), F.lit(r"""(?i)<a\b[^>]*?href=["']([^"'#]+)"""), F.lit(1))
        out = pages.select("url", F.posexplode(hrefs).alias("ord", "href")).withColumn("target", F.regexp_replace(K.absolute_link("href", "url"), r"[?#].*$", ""))
        path = F.regexp_replace("target", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
        return out.filter((K.url_host("target") == K.url_host(origin)) & ((F.rtrim(path, F.lit("/")) == root) | path.startswith(root + "/"))).select("url", "ord", "target")

    kept = SnapshotStore(index.sparkSession, f"{w.store.root}/raw")
    known = kept.read()
    pages = cut_here(crawl(index.select("url", F.lit(0).alias("ord")), w.get, links, known))
    bad = pages.filter("status NOT IN (200, 304, 404)")
    if w.spec.failure == "abort" and not bad.isEmpty():
        raise SourceFailed(f"{w.spec.name}: {bad.count()} pages failed; nothing was changed")
    gates = pages.select(F.lit("").alias("scope"), F.col("status").isin(200, 304, 404).alias("complete"))
    text = F.col("body").cast("string")
    status = F.when(F.col("body").isNotNull(), 200).otherwise(F.col("status"))
    token = F.when(F.col("body").isNotNull(), F.coalesce("etag", F.sha2(F.col("body"), 256)))
    return Found(_found(pages, F.col("url"), token, T.html_title(text), text, status, F.col("etag")), gates)


def _shards(index: DataFrame, w: World) -> Found:
    rows, gates = D.sitemap_tree(index, w.get, w.start.split("/")[2])
    return Found(_found(rows, F.col("url"), F.col("lastmod"), scope=F.col("scope")), gates)


def _sidebar(index: DataFrame, w: World) -> DataFrame:
    prefix = w.spec.within or "/docs"
    rows = D.sidebar(index, prefix, html="text")
    return _found(rows, F.concat(F.lit(_origin(w.start) + prefix.rstrip("/") + "/"), "slug"), title=F.col("title"))


def _directory(index: DataFrame, w: World) -> DataFrame:
    rows = D.json_directory(index, "id:string,title:string,version:string,discoveryRestUrl:string,url:string", body="text")
    return _found(rows, F.coalesce("url", "discoveryRestUrl"), F.col("version"), F.coalesce("title", "id"))


def _landing(index: DataFrame, w: World) -> DataFrame:
    """The landing page, the pages below the prefix that it links to, and the pages that stand above those."""
    prefix = (w.spec.within or "/" + "/".join(w.start.split("/")[3:])).strip("/")
    hrefs = index.select("url", F.explode(F.regexp_extract_all("text", F.lit(r"""(?i)href=["']([^"'#]+)"""), F.lit(1))).alias("href")).withColumn("target", F.regexp_replace(K.absolute_link("href", "url"), r"[?#].*$", ""))
    paths = hrefs.filter(K.url_host("target") == F.lit(w.start.split("/")[2])).select(K.url_path("target").alias("path")).filter(F.col("path").startswith(prefix + "/")).distinct()
    above = G.derived_parents(paths).filter(F.col("path").startswith(prefix + "/"))
    every = paths.unionByName(above).unionByName(index.select(K.url_path("url").alias("path"))).distinct()
    return _found(every, F.concat(F.lit(_origin(w.start) + "/"), "path"))


_NAMED = "#name="  #: behind a URL that says nothing of its page: the path that the output gets
_TOTAL = "$.meta.pagination['total-pages']"


def _registry(index: DataFrame, w: World) -> Found:
    """Documents of a registry: its pages of providers, or those asked for, each one's newest version, and what that lists; nothing of a provider that is current."""
    spark, root = index.sparkSession, _origin(w.start)
    if w.providers:
        providers = spark.createDataFrame([(p,) for p in w.providers], "provider string")
        gates = None
    else:
        number = lambda u, page: F.concat(u, F.lit("&page[number]="), page.cast("string"))
        pages = Q.all_pages(index.select("url"), w.get, F.get_json_object("body", _TOTAL), number)
        kind = "struct<data:array<struct<attributes:struct<`full-name`:string>>>>"
        providers = pages.filter("status = 200").select(F.explode(F.from_json("body", kind)["data"]["attributes"]["full-name"]).alias("provider")).filter("provider IS NOT NULL").distinct()
        gates = pages.select(F.lit("").alias("scope"), (F.col("status") == 200).alias("complete"))
    known = SnapshotStore(spark, f"{w.store.root}/settled").read("provider string, version string, fingerprint string, engine string").filter(F.lit(not w.force) & (F.col("engine") == w.engine))
    lost = w.store.read(STATE).filter(~F.coalesce("output_exists", F.lit(False))).select(F.substring_index("scope", "|", -1).alias("__lost")).distinct()
    known = known.join(lost, F.col("provider") == F.col("__lost"), "left_anti")
    docs, told = Q.registry_documents(cut_here(providers), w.get, f"{root}/v1/providers", known)
    own = told.filter("NOT current").select(F.col("provider").alias("scope"), "complete")
    gates = own if gates is None else gates.unionByName(own)
    place = F.concat_ws("/", "provider", "category", "slug")
    rows = _found(docs, F.concat(F.lit(f"{root}/v2/provider-docs/"), "id", F.lit(_NAMED), place), F.concat_ws("@", "version", "id"), F.col("title"), scope=F.col("provider"))
    return Found(rows, gates, told)


_WIKI = {"action": "query", "format": "json", "formatversion": "2"}


def _wiki(index: DataFrame, w: World) -> Found:
    """Articles of a wiki: titles with revisions by cursor, then contents of those that are new or changed, fifty a request."""
    api = w.start.split("?")[0]
    first = index.select(F.lit(w.spec.name).alias("source"), "url")
    text = F.col("body").cast("string")
    listed = cursor_pages(first, w.get, lambda r: Q.continued(r.withColumn("body", text), "source"))
    if not listed.filter("status <> 200").isEmpty():
        raise SourceFailed(f"{w.spec.name}: titles can't be had; nothing was changed")
    kind = "struct<query:struct<pages:array<struct<title:string,revisions:array<struct<revid:bigint>>>>>>"
    titles = listed.select(F.explode(F.from_json(text, kind)["query"]["pages"]).alias("p")).select(F.col("p.title").alias("key"), F.get("p.revisions.revid", F.lit(0)).cast("string").alias("revision")).filter("key IS NOT NULL").dropDuplicates(["key"])
    titles = cut_here(titles.filter(~K.translated_title("key", K.LANGUAGES)))
    url = F.concat(F.lit(_origin(w.start) + "/title/"), F.replace("key", F.lit(" "), F.lit("_")))
    named = titles.withColumn("url", url).withColumn("__name", output_key(w.spec, F.col("url")))
    old = w.state().select(F.col("key").alias("__k"), F.substring_index("token", "\u0001", -1).alias("__t"))
    due = named.join(old, (F.col("__name") == F.col("__k")) & F.col("revision").eqNullSafe(F.col("__t")), "left_anti").select("key")
    replies, batches = Q.in_batches(due, w.get, Q.wiki_url(api, **_WIKI, prop="revisions%7Ccategories", rvprop="content%7Cids", rvslots="main", cllimit="max"), Q.continued, F.get_json_object("body", "$.error").isNotNull())
    content = D.wiki_pages(replies.filter("status = 200"), body="body")[0]
    told = Q.outcome_by_key(batches, content.withColumnRenamed("title", "key"))
    if w.spec.failure == "abort" and not batches.filter("failed").isEmpty():
        raise SourceFailed(f"{w.spec.name}: {batches.filter('failed').count()} batches failed; nothing was changed")
    both = named.join(told.withColumnRenamed("key", "__o"), F.col("key") == F.col("__o"), "left").join(content.select(F.col("title").alias("__c"), "content"), F.col("key") == F.col("__c"), "left")
    status = F.when(F.col("outcome") == "found", 200).when(F.col("outcome") == "missing", 404).when(F.col("outcome") == "failed", 0).otherwise(304)
    return Found(_found(both, F.col("url"), F.col("revision"), F.col("key"), F.col("content"), status))


def _bundles(index: DataFrame, w: World) -> Found:
    chunks, complete = Q.bundle_chain(index, w.get, _origin(w.start))
    page = F.concat(F.lit(_origin(w.start)), "route")
    return Found(_found(chunks, page, F.sha2(F.col("body").cast("binary"), 256), body=F.col("body"), status=F.col("status")), complete.select(F.lit("").alias("scope"), "complete"))


#: Each takes (index rows (source, url, status, text), world); 'fixed' has no index: its address is the page.
DISCOVERIES: dict[str, Callable[[DataFrame, World], DataFrame | Found]] = {
    "fixed": lambda i, w: _found(i, F.col("url")),
    "first_valid": lambda i, w: _found(D.first_valid(i.withColumn("ord", F.lit(0)), body="text"), F.col("url"), body=F.col("text")),
    "link_index": lambda i, w: _found(r := D.link_index(i), K.absolute_link("url", F.lit(w.start)), title=r["title"], summary=r["summary"]),
    "concatenated_pages": lambda i, w: _found(D.concatenated_pages(i), F.col("url"), T.content_hash("body"), F.col("title"), F.col("body")),
    "sitemap_urls": lambda i, w: _found(D.sitemap_urls(i, "text"), F.col("url")),
    "sitemap_by_path": lambda i, w: _found(D.sitemap_by_path(i, "text"), F.col("url")),
    "sitemap_tree": _shards,
    "tree_files": lambda i, w: _found(D.tree_files(i, [w.spec.within.lstrip("/")], [".md", ".mdx", ".html"], body="text"), _below(w, F.col("path")), F.col("sha")),
    "navigation": lambda i, w: _found(D.navigation(i).filter("page IS NOT NULL"), _below(w, F.col("page")), title=F.col("title")),
    "sidebar": _sidebar,
    "english_paths": lambda i, w: _found(D.english_paths(D.sitemap_urls(i, "text"), w.spec.within or "/docs/"), F.col("url")),
    "sphinx_names": lambda i, w: _found(D.sphinx_names(i, script="text"), _below(w, F.col("name"), ".rst.txt"), title=F.col("name")),
    "wiki_articles": _wiki,
    "json_directory": _directory,
    "page_data": lambda i, w: _found(D.page_data(i, body="text"), F.col("url"), title=F.col("title"), body=F.col("script")),
    "embedded_object": lambda i, w: _found(D.embedded_object(i, "openapi", "3.0.0", html="text"), F.col("url"), body=F.col("json")),
    "registry_documents": _registry,
    "bundle_chain": _bundles,
    "reachable": _reached,
    "landing_links": _landing,
}

_HTML = lambda dialect: lambda r: V.html_to_markdown("body", dialect, F.col("url"), F.col("title"))
#: One document from one body, a column over (url, title, summary, body).
PAGES: dict[str, Callable[[DataFrame], Column]] = {
    "preamble": lambda r: T.with_preamble("body", F.coalesce(T.first_present("title", T.markdown_title("body")), F.lit("")), "url"),
    "titled_page": lambda r: T.titled_page("body", "title", "url"), "sourced_page": lambda r: T.sourced_page("body", "title", "url"), "bannered_page": lambda r: T.sourced_page("body", "title", "url", banner=True),
    "headed_page": lambda r: T.headed_page("body", "title", "url", "summary"),
    "concatenated_page": lambda r: T.concatenated_page("body", "title", "url"), "without_components": lambda r: T.without_components("body"),
    "without_front_matter": lambda r: T.without_front_matter("body"), "mdx_to_markdown": lambda r: V.mdx_to_markdown("body"), "jekyll_to_markdown": lambda r: V.jekyll_to_markdown("body"),
    "mkdocs_to_markdown": lambda r: V.mkdocs_to_markdown("body"), "shortcodes_to_markdown": lambda r: V.shortcodes_to_markdown("body"), "wikitext_to_markdown": lambda r: V.wikitext_to_markdown("body"),
    "compiled_to_markdown": lambda r: V.compiled_to_markdown("body")["markdown"], "canonical_json": lambda r: V.canonical_json("body"), "vendor_document": lambda r: V.vendor_document("body"),
    "registry_document": lambda r: T.without_front_matter(F.get_json_object("body", "$.data.attributes.content")),
}


def _made(rows: DataFrame, key: Column, title: Column, content: Column) -> DataFrame:
    return rows.select("url", key.alias("key"), title.alias("title"), content.alias("content"))


def _endpoints(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    made = V.endpoint_documents(rows.withColumn("body", F.coalesce(V.yaml_to_json("body"), "body")), "url", "body")
    return _made(made, F.concat(K.slug("tag"), F.lit("/"), "file"), F.coalesce("summary", F.lit("")), F.col("markdown"))


def _slices(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """The documents inside pages, below each page's own name, with links between them; each part has its own kinds of documents."""
    out = []
    for k, start in enumerate(dict.fromkeys(start for _, start, _ in parts_of(spec))):
        mine = rows.filter(F.col("url") == start)
        made = P.relinked(P.sliced(mine, spec.kinds[min(k, len(spec.kinds) - 1)], "url", "body"), "url")
        folder = F.regexp_replace(F.regexp_replace(output_key(spec, F.col("url")), r"\.md$", ""), r"^index$", "")
        out.append(_made(made, F.concat_ws("/", F.nullif(folder, F.lit("")), "path"), F.col("title"), F.concat(F.lit("# "), "title", F.lit("\n\n"), "markdown")))
    return reduce(DataFrame.unionByName, out)


def _routed(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """Each body by the one converter for what it is; bodies of no known kind make no document."""
    packed = V.packed_description("body")
    rows = cut_here(rows.withColumn("kind", V.body_kind("body")).withColumn("body", F.when(F.col("kind") == "packed", packed).otherwise(F.col("body"))).withColumn("kind", F.when(F.col("kind") == "packed", F.lit("openapi")).otherwise(F.col("kind"))))
    pick = lambda *kinds: rows.filter(F.col("kind").isin(*kinds))
    key = output_key(spec, F.col("url"))
    texts = {"compiled": V.compiled_to_markdown("body")["markdown"], "mdx": V.mdx_to_markdown("body"), "html": V.html_to_markdown("body", "plain", F.col("url"), F.col("title")), "markdown": T.without_front_matter("body"), "vendor": V.vendor_document("body")}
    parts = [_endpoints(pick("openapi", "swagger"), spec), MANY["postman_documents"](pick("postman"), spec)]
    parts += [_made(pick(kind), key, T.first_present("title", T.markdown_title(content), F.lit("")), content) for kind, content in texts.items()]
    return reduce(DataFrame.unionByName, parts).filter("content IS NOT NULL")


#: Many documents from one body: (url, title, body) to (url, key, title, content) rows.
MANY: dict[str, Callable[[DataFrame, SourceSpec], DataFrame]] = {
    "endpoint_documents": _endpoints,
    "postman_documents": lambda r, s: _made(V.postman_documents(r.withColumnRenamed("url", "__url"), "__url", "body").drop("url").withColumnRenamed("__url", "url"), F.concat_ws("/", F.nullif(K.slug("folder", fallback=""), F.lit("")), F.concat(K.slug("name"), F.lit(".md"))), F.col("name"), F.col("markdown")),
    "protocol_documents": lambda r, s: _made(V.protocol_documents(r, "url", "body"), F.col("file"), F.lit(""), F.col("markdown")),
    "rst_to_markdown": lambda r, s: _made(V.rst_to_markdown(r.select("url", F.regexp_replace(_path_of(s, F.col("url")), r"\.rst(?:\.txt)?$", "").alias("name"), F.col("body").alias("text"), "title")), K.output_path("name"), F.col("title"), F.col("markdown")),
    "slices": _slices,
    "routed": _routed,
}


def _path_of(spec: SourceSpec, url: Column) -> Column:
    """The path of a URL, or the name behind it, without what the source strips; '/' for what is stripped itself."""
    path = K.url_path(F.coalesce(F.nullif(F.regexp_extract(url, _NAMED + "(.+)$", 1), F.lit("")), url))
    if not spec.strip:
        return path
    top = spec.strip.strip("/")
    return F.when(path == top, F.lit("/")).when(path.startswith(top + "/"), F.substr(path, F.lit(len(top) + 2))).otherwise(path)


def output_key(spec: SourceSpec, url: Column) -> Column:
    """The output path of a page: its path, without what the source strips and its text's suffix, as the source's rules rewrite it."""
    return K.output_path(K.rewritten(F.regexp_replace(_path_of(spec, url), r"\.(?:md|mdx|html)$", ""), spec.rules))


def parts_of(spec: SourceSpec) -> list[tuple[str, str, str]]:
    """(discovery, start, converter) of each part; of what there is one of less, the last serves all that follow."""
    discoveries, converters = spec.discovery.split("+"), spec.converter.split("+")
    starts = [spec.url, *spec.also]
    last = lambda items, k: items[min(k, len(items) - 1)]
    return [(last(discoveries, k), last(starts, k), last(converters, k)) for k in range(max(len(discoveries), len(converters), len(starts)))]


def check(spec: SourceSpec) -> None:
    """Raise where a row names what nothing here is called."""
    for discovery, _, converter in parts_of(spec):
        name, _, dialect = converter.partition(":")
        if discovery not in DISCOVERIES or name not in (*PAGES, *MANY, "html_to_markdown") or dialect not in ("", *V.html_md.DIALECTS):
            raise ValueError(f"{spec.name}: {discovery} with {converter} can't be run")
    if spec.failure not in ("page", "scope", "abort") or spec.policy not in transport.POLICIES:
        raise ValueError(f"{spec.name}: {spec.failure}, {spec.policy}")


#: Discoveries whose rows are addresses alone, so that a manifest may be used again.
MANIFESTS = ("link_index", "sitemap_urls", "sitemap_by_path", "sitemap_tree", "tree_files", "english_paths", "sidebar", "navigation", "landing_links")


INDEX, INDEX_SCOPE = "README.md", "index|"


def write_index(store: SnapshotStore, name: str, options: Options) -> Outcome:
    """Index pages of a state, as rows of it: for each folder its pages by title, at the top each folder with how many it has.

    They are planned, told apart by their hashes, committed and removed like all other rows, in a scope of their own. A page
    of the source that has an index page's name stays, and that folder gets none.
    """
    own = F.coalesce("scope", F.lit("")) == INDEX_SCOPE
    pages = store.read(STATE).filter(~own & ~F.col("key").startswith(ARCHIVE)).select("key", F.coalesce("title", F.lit("")).alias("title"))
    folder = F.regexp_replace("key", r"/?[^/]*$", "")
    file = F.regexp_extract("key", r"([^/]*)$", 1)
    rows = pages.withColumn("folder", folder).filter(F.col("folder") != "")
    line = F.concat(F.lit("- ["), T.first_present("title", F.regexp_replace(file, r"\.md$", "")), F.lit("]("), file, F.lit(")"))
    inside = C.readme(rows, F.col("folder"), "folder", line, "key").select(F.concat("folder", F.lit(f"/{INDEX}")).alias("key"), F.col("folder").alias("title"), F.col("content").alias("body"))
    counted = C.counts(rows, "folder").select(F.lit(name).alias("source"), "folder", F.concat(F.lit("- ["), "folder", F.lit("]("), "folder", F.lit(f"/{INDEX}): "), F.col("n").cast("string"), F.lit(" pages")).alias("line"))
    flat = pages.filter(folder == "").select(F.lit(name).alias("source"), F.col("key").alias("folder"), F.concat(F.lit("- ["), T.first_present("title", F.regexp_replace("key", r"\.md$", "")), F.lit("]("), "key", F.lit(")")).alias("line"))
    top = C.listing(counted.unionByName(flat), ["source"], F.col("line"), "folder").select(F.lit(INDEX).alias("key"), F.col("source").alias("title"), F.concat(F.lit("# "), "source", F.lit("\n\n"), "lines", F.lit("\n")).alias("body"))
    taken = pages.select(F.col("key").alias("__taken"))
    made = cut_here(inside.unionByName(top).join(taken, F.col("key") == F.col("__taken"), "left_anti"))
    bodies = made.select(F.col("key").alias("__k"), "title", "body")
    fetch = lambda wanted: wanted.select("key").join(bodies, F.col("key") == F.col("__k")).select("key", F.lit(200).alias("status"), "body")
    convert = lambda rows: rows.join(bodies.drop("body"), F.col("key") == F.col("__k")).select("key", "title", F.col("body").alias("content"))
    gates = made.sparkSession.createDataFrame([(INDEX_SCOPE, True, 0)], "scope string, complete boolean, least_rows int")
    o = replace(options, scope=None, limit=None, part=None, gates=gates, complete=True, least_rows=0, force=False)
    return synchronise(made.select("key", T.content_hash("body").alias("token"), F.lit(INDEX_SCOPE).alias("scope")), fetch, convert, store, o)


class _Incomplete(Exception):
    """A manifest that must not be kept."""


def run_source(
    spark: SparkSession, spec: SourceSpec | str, store: SnapshotStore, get: Get | None = None, options: Options | None = None, head: Get | None = None, raw: str | None = None, manifests: str | None = None,
    hours: float = 24, providers: Sequence[str] = (), verify: Callable[[], None] | None = None, commits: int = 0, index_pages: bool = False,
) -> Outcome:
    """One run of a source from its index to the commit.

    An index that can't be had ends the run ('abort'), or closes the gates of its part ('page', 'scope'). A page that fails keeps
    its old content, a description that fails keeps all of its documents, or either ends the run ('abort'). Without a change
    token pages are asked for on every run, with the validator that they came with.

    head: a look at validators, for sources that probe. raw: where descriptions are kept as they came. manifests: where
    discovered addresses are kept and used again for hours. providers: those of a registry that are wanted. verify: called
    before anything is fetched; it raises where the source does not let us in. commits: in how many parts a long run commits.
    index_pages: whether index pages are kept beside the pages.
    """
    spec = SOURCES[spec] if isinstance(spec, str) else spec
    check(spec)
    if verify is not None:
        verify()
    o = options or Options()
    get = get or online(spec.policy)
    if spec.probe:
        get = probed(get, head or online(spec.policy, send=transport.head_transport))
    engine = engine_of(V.html_to_markdown, V.html_md.html_to_markdown, V.wiki_md.wikitext_to_markdown, V.rst_md.rst_to_markdown, V.mdx_md.mdx_to_markdown, V.compiled_mdx.compiled_to_markdown, spec_md.endpoint)[:16]
    old = store.read(STATE)
    pages, gates, settled, any_index = [], [], None, False

    def scoped(k: int, scope: Column) -> Column:
        return F.concat(F.lit(f"{k}|"), scope)

    def carried(k: int, scopes: DataFrame) -> DataFrame:
        """The rows that the state has of scopes (scope), as they are."""
        token = F.when(F.contains("token", F.lit("\u0001")), F.substring_index("token", "\u0001", -1))
        rows = old.join(scopes.select(F.col("scope").alias("__s")).distinct(), F.col("scope") == F.col("__s"), "left_semi")
        return rows.select("key", F.lit(None).cast("string").alias("url"), token.alias("token"), "title", F.lit(None).cast("string").alias("body"), F.lit(304).alias("status"), "etag", "scope", F.lit("").alias("converter"), F.lit(k).alias("part"), F.lit("").alias("summary"))

    for k, (discovery, start, converter) in enumerate(parts_of(spec)):
        asked = spark.createDataFrame([(start, None)], _ASKED)
        w = World(spec, start, get, store, engine, o.force, tuple(providers))
        name, _, dialect = converter.partition(":")
        if discovery == "fixed":
            found = Found(DISCOVERIES[discovery](asked, w))
        else:
            index = cut_here(get(asked).select(F.lit(spec.name).alias("source"), "url", "status", F.col("body").cast("string").alias("text"), "etag"))
            if index.filter("status = 200").isEmpty():
                if spec.failure == "abort":
                    raise SourceFailed(f"{spec.name}: {start} can't be had; nothing was changed")
                continue

            def discovered(discovery=discovery, index=index, w=w) -> Found:
                out = DISCOVERIES[discovery](index.filter("status = 200"), w)
                return out if isinstance(out, Found) else Found(out)

            if manifests and discovery in MANIFESTS:
                told: list[Found] = []

                def make() -> DataFrame:
                    told.append(discovered())
                    if told[0].gates is not None and not told[0].gates.filter("NOT complete").isEmpty():
                        raise _Incomplete
                    return told[0].rows

                try:
                    found = Found(reused(spark, f"{manifests.rstrip('/')}/{spec.name}-{k}", make, hours)[0])
                    found = replace(found, gates=found.rows.select("scope", F.lit(True).alias("complete")).distinct())
                except _Incomplete:
                    found = told[0]
            else:
                found = discovered()
        any_index = True
        rows = found.rows
        if spec.within and discovery not in ("tree_files", "reachable"):
            rows = rows.filter(F.concat(F.lit("/"), K.url_path("url")).startswith(spec.within.rstrip("/")))
        if spec.suffix:
            rows = rows.withColumn("url", F.when(F.endswith("url", F.lit(spec.suffix)), F.col("url")).otherwise(F.concat(F.rtrim("url", F.lit("/")), F.lit(spec.suffix))))
        if found.settled is not None:
            settled = found.settled
        if name in MANY:  # bodies become documents before the plan: their hashes are the tokens
            rows = rows.withColumn("scope", scoped(k, F.col("url")))
            valid = old.filter(made_by("token", engine)).groupBy("scope").agg(F.when(F.count("etag") == F.count("*"), F.when(F.min("etag") == F.max("etag"), F.max("etag"))).alias("known")).select(F.col("scope").alias("__s"), "known")
            rows = cut_here(rows.join(valid, F.col("scope") == F.col("__s"), "left").drop("__s"))
            need = Q.ask(rows.filter("status IS NULL").select("url", "title", "scope", (F.lit(None).cast("string") if o.force else F.col("known")).alias("known")), get, "known")
            whole = cut_here(rows.filter("status IS NOT NULL").select("url", "title", "scope", "status", "body", "etag").unionByName(need.select("url", "title", "scope", "status", "body", "etag")))
            lost = whole.filter("status NOT IN (200, 304)")
            if spec.failure == "abort" and not lost.isEmpty():
                raise SourceFailed(f"{spec.name}: {lost.count()} descriptions can't be had; nothing was changed")
            here = whole.filter("status = 200")
            if raw:
                cut_here(archive_raw(here.withColumn("source", F.lit(spec.name)), raw))
            made = MANY[name](here.select("url", "title", "body"), spec).join(here.select(F.col("url").alias("__u"), "scope", "etag"), F.col("url") == F.col("__u"))
            pages.append(made.select("key", F.concat("url", F.lit("#"), "key").alias("url"), T.content_hash("content").alias("token"), "title", F.col("content").alias("body"), F.lit(200).alias("status"), "etag", "scope", F.lit("").alias("converter"), F.lit(k).alias("part"), F.lit("").alias("summary")))
            pages.append(carried(k, whole.filter("status = 304")))
            gates.append(whole.select("scope", F.col("status").isin(200, 304).alias("complete"), F.lit(1).alias("least_rows")))
            complete = found.gates is None or found.gates.filter("NOT complete").isEmpty()
            listed = whole.select("scope").distinct()
        else:
            rows = rows.withColumn("scope", scoped(k, F.col("scope")))
            pages.append(rows.select(output_key(spec, F.col("url")).alias("key"), "url", "token", "title", "body", "status", "etag", "scope", F.lit(converter).alias("converter"), F.lit(k).alias("part"), "summary"))
            own = found.gates if found.gates is not None else spark.createDataFrame([("", True)], "scope string, complete boolean")
            own = cut_here(own.select(scoped(k, F.col("scope")).alias("scope"), "complete"))
            gates.append(own.withColumn("least_rows", F.lit(1)))
            # A failed scope that has pages of its own names no others: what else is gone is known all the same.
            has = old.select(F.col("scope").alias("__s")).distinct()
            complete, listed = own.filter("NOT complete").join(has, F.col("scope") == F.col("__s"), "left_anti").isEmpty(), own.select("scope").distinct()
            if found.settled is not None:
                now = found.settled.filter("current").select(scoped(k, F.col("provider")).alias("scope"))
                pages.append(carried(k, now))
                gates.append(now.select("scope", F.lit(True).alias("complete"), F.lit(1).alias("least_rows")))
                listed = listed.unionByName(now)
                complete = complete and not providers
        if complete:  # scopes of this part that a complete index names no more are gone
            before = old.filter(F.col("scope").startswith(f"{k}|")).select(F.col("scope").alias("__s")).distinct()
            gone = before.join(listed, F.col("__s") == F.col("scope"), "left_anti")
            gates.append(gone.select(F.col("__s").alias("scope"), F.lit(True).alias("complete"), F.lit(0).alias("least_rows")))
    if not any_index:
        raise SourceFailed(f"{spec.name}: no index can be had; nothing was changed")
    every = cut_here(reduce(DataFrame.unionByName, pages))
    first = every.groupBy("key").agg(F.min(F.struct("part", F.coalesce("url", F.lit("")).alias("url"))).alias("w")).select(F.col("key").alias("__k"), F.col("w.part").alias("__p"), F.col("w.url").alias("__w"))
    every = cut_here(every.join(first, (F.col("key") == F.col("__k")) & (F.col("part") == F.col("__p")) & (F.coalesce("url", F.lit("")) == F.col("__w"))).drop("__k", "__p", "__w").dropDuplicates(["key"]))
    known = every.select(F.col("key").alias("__k"), F.col("url").alias("__url"), F.col("title").alias("__title"), F.col("converter").alias("__how"), F.col("body").alias("__body"), F.col("status").alias("__status"), F.col("etag").alias("__etag"), F.col("summary").alias("__summary"))

    def fetch(wanted: DataFrame) -> DataFrame:
        rows = cut_here(wanted.select("key", "etag").join(known, F.col("key") == F.col("__k")))
        here = rows.filter("__status IS NOT NULL").select("key", F.col("__status").alias("status"), F.col("__body").alias("body"), F.col("__etag").alias("etag"))
        asked = rows.filter("__status IS NULL").select("key", F.regexp_replace("__url", _NAMED + ".*$", "").alias("url"), F.col("etag").alias("known"))
        return here.unionByName(Q.ask(asked, get, "known").select("key", "status", "body", "etag"))

    def convert(bodies: DataFrame) -> DataFrame:
        shown = F.regexp_replace("__url", rf"\Q{spec.suffix}\E$", "") if spec.suffix else F.col("__url")  # the page's own address
        rows = bodies.join(known.drop("__body"), F.col("key") == F.col("__k")).select("key", shown.alias("url"), F.col("__title").alias("title"), F.col("__summary").alias("summary"), "body", "__how")
        out = None
        for how in dict.fromkeys(["", *(c for _, _, c in parts_of(spec) if c.partition(":")[0] not in MANY)]):
            name, _, dialect = how.partition(":")
            mine = rows.filter(F.col("__how") == how)
            content = F.col("body") if not how else (_HTML(dialect or "plain") if name == "html_to_markdown" else PAGES[name])(mine)
            part = mine.select("key", T.first_present("title", T.markdown_title("body"), F.lit("")).alias("title"), content.alias("content"))
            out = part if out is None else out.unionByName(part)
        return out

    declared = cut_here(reduce(DataFrame.unionByName, gates))
    o = replace(o, gates=declared, least_rows=max(o.least_rows, spec.least_rows), abort_on_failure=o.abort_on_failure or spec.failure == "abort", engine=engine)
    plan = every.select("key", "token", "scope")
    out = synchronise_in_parts(plan, fetch, convert, store, o, commits)[1] if commits else synchronise(plan, fetch, convert, store, o)
    if out.version is not None:
        if any(d == "reachable" for d, _, _ in parts_of(spec)):
            bodies = every.filter("body IS NOT NULL AND etag IS NOT NULL").select("url", "etag", F.col("body").cast("binary").alias("body")).dropDuplicates(["url"])
            kept = SnapshotStore(spark, f"{store.root}/raw")
            before = kept.read("url string, etag string, body binary").select(F.col("url").alias("__u"), F.col("etag").alias("__e"))
            kept.append(bodies.join(before, (F.col("url") == F.col("__u")) & (F.col("etag") == F.col("__e")), "left_anti"), key="url")
        if settled is not None:  # a provider's fingerprint counts only after all of its documents came
            outcomes = out.rows.join(plan.select(F.col("key").alias("__k"), F.substring_index("scope", "|", -1).alias("provider")), F.col("key") == F.col("__k"))
            full = S.settled_tokens(outcomes, settled.filter("complete AND NOT current").select("provider", "version", "fingerprint", F.lit(engine).alias("engine")), "provider")
            SnapshotStore(spark, f"{store.root}/settled").append(full, key="provider")
        if index_pages:
            more = write_index(store, spec.name, o)
            counts = {k: out.counts.get(k, 0) + more.counts.get(k, 0) for k in {**out.counts, **more.counts}}
            out = replace(out, rows=out.rows.unionByName(more.rows), counts=counts, version=more.version)
    return out
