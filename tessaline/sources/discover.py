"""Discovery over landed bytes: sitemaps, link indexes, trees, navigation, bundles, directories. Rows in, manifest rows out.

Every manifest has the order of discovery in `ord`, as order is part of what sources say. Texts stay in their rows (one
sitemap shard, one index); only what is found in them is exploded, and no row is ever collected.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import keys as K
from ..functions import text as T
from ..operators import relational as R
from ..plans.store import Pile, cut_here


def sitemap_urls(shards: DataFrame, xml: str = "xml", keep: Sequence[str] = ()) -> DataFrame:
    """(ord, url) of every <loc>, without regard to name spaces; keep names columns of shards."""
    found = F.regexp_extract_all(xml, F.lit(r"<(?:\w+:)?loc>\s*([^<]+?)\s*</(?:\w+:)?loc>"), F.lit(1))
    return shards.select(*keep, F.posexplode(found).alias("ord", "url")).withColumn("url", T.unescaped("url"))


def sitemap_by_path(shards: DataFrame, xml: str = "xml") -> DataFrame:
    """(ord, url) by XPath, for documents that are well formed."""
    return shards.select(F.posexplode(F.xpath(xml, F.lit("//*[local-name()='loc']/text()"))).alias("ord", "url"))


def sharded_sitemap(shards: DataFrame, host: str, shard: str = "shard", xml: str = "xml") -> tuple[DataFrame, DataFrame]:
    """((path, lastmod), complete): the entries of all shards on host, of repeated paths the last; whether each shard had any.

    complete is one row (complete, shards, broken): null or entry-less shards make a manifest incomplete.
    """
    entries = F.regexp_extract_all(xml, F.lit(r"(?s)<url>(.*?)</url>"), F.lit(1))
    rows = shards.select(shard, F.posexplode(entries).alias("ord", "entry"))
    url = T.unescaped(F.regexp_extract("entry", r"<loc>\s*([^<]+?)\s*</loc>", 1))
    rows = rows.select(shard, "ord", url.alias("url"), F.nullif(F.regexp_extract("entry", r"<lastmod>\s*([^<]+?)\s*</lastmod>", 1), F.lit("")).alias("lastmod"))
    rows = rows.filter(K.url_host("url") == host).withColumn("path", K.url_path("url"))
    last = R.last_wins(rows.select("path", shard, "ord", "lastmod"), ["path"], [shard, "ord"]).select("path", "lastmod")
    ok = F.coalesce(F.contains(xml, F.lit("<loc>")), F.lit(False))
    return last, shards.agg(F.coalesce(F.bool_and(ok), F.lit(False)).alias("complete"), F.count("*").alias("shards"), F.count_if(~ok).alias("broken"))


def sitemap_tree(index: DataFrame, get: Callable[[DataFrame], DataFrame], host: str, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """((scope, path, url, lastmod), shards): a sitemap, or an index of sitemaps and those it names, fetched one after the other.

    index: (url, status, text) of what stands at the start. shards has (scope, complete) for every sitemap that was asked for:
    its URL, and whether it came and has entries or names further sitemaps. Sitemaps of a round are fetched together, each
    once, however often it is named; `most` levels below each other. Of a path that several have, the last by (level,
    scope, place) counts. Only entries on host count.
    """
    spark = index.sparkSession
    loc = lambda tag: F.regexp_extract_all("text", F.lit(rf"(?s)<(?:\w+:)?{tag}>(.*?)</(?:\w+:)?{tag}>"), F.lit(1))
    inner = lambda c, tag: F.nullif(T.unescaped(F.trim(F.regexp_extract(c, rf"<(?:\w+:)?{tag}>\s*([^<]*?)\s*</", 1))), F.lit(""))
    files = Pile(spark, StructType.fromDDL("url string, status int, text string, level int"))
    now = cut_here(index.select("url", "status", "text", F.lit(0).alias("level")))
    for level in range(1, most + 1):
        files.add(now)
        named = now.filter("status = 200").select(F.explode(loc("sitemap")).alias("entry")).select(inner("entry", "loc").alias("url")).filter("url IS NOT NULL").distinct()
        seen = files.read().select(F.col("url").alias("__seen"))
        named = cut_here(named.filter(K.url_host("url") == host).join(seen, F.col("url") == F.col("__seen"), "left_anti"))
        if named.isEmpty():
            break
        if level == most:
            raise ValueError(f"sitemaps below each other on more than {most} levels")
        replies = get(named.withColumn("etag", F.lit(None).cast("string"))).select(F.col("url").alias("__u"), "status", F.col("body").cast("string").alias("text"))
        now = cut_here(named.join(replies, F.col("url") == F.col("__u"), "left").select("url", F.coalesce("status", F.lit(0)).alias("status"), "text", F.lit(level).alias("level")))
    every = files.read()
    complete = (F.col("status") == 200) & F.coalesce(F.rlike("text", F.lit(r"<(?:\w+:)?loc>\s*[^<\s]")), F.lit(False))
    entries = every.filter("status = 200").select("level", F.col("url").alias("scope"), F.posexplode(loc("url")).alias("ord", "entry"))
    rows = entries.select("level", "scope", "ord", inner("entry", "loc").alias("url"), inner("entry", "lastmod").alias("lastmod")).filter(K.url_host("url") == host).withColumn("path", K.url_path("url"))
    return R.last_wins(rows, ["path"], ["level", "scope", "ord"]).select("scope", "path", "url", "lastmod"), every.select(F.col("url").alias("scope"), complete.alias("complete"))


def link_index(indexes: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, ord, section, title, url, summary) of `- [Title](url): summary` below `## Section`; of a url the first."""
    lines = R.lines_of(indexes, source, text)
    lines = R.running_value(lines, source, "ord", F.nullif(F.trim(F.regexp_extract("line", r"^##\s+(.+)$", 1)), F.lit("")), "section")
    item = r"^\s*[-*]\s+\[([^\]]+)\]\(([^)\s]+)\)(?::?\s*(.*))?$"
    rows = lines.filter(F.col("line").rlike(item)).select(source, "ord", "section", F.regexp_extract("line", item, 1).alias("title"), F.regexp_extract("line", item, 2).alias("url"), F.trim(F.regexp_extract("line", item, 3)).alias("summary"))
    return R.first_wins(rows, [source, "url"], ["ord"])


def concatenated_pages(corpora: DataFrame, text: str = "text", source: str = "source", order: str | None = None) -> DataFrame:
    """(source, url, ord, title, body) of texts that join pages as `# Title` and `Source: url`; of a url the last.

    With order, a source's text comes in slices of whole pages, a row for each, so that no row holds it all: of a url the last
    in any slice counts, and ord is (order, place in the slice).
    """
    parts = corpora.select(source, *([order] if order else []), F.posexplode(F.split(text, r"(?m)^(?=# [^\n]*\nSource: )")).alias("ord", "part"))
    if order:
        parts = parts.withColumn("ord", F.struct(F.col(order).alias("slice"), "ord")).drop(order)
    head = r"(?s)\A# ([^\n]*)\nSource: (\S+)[^\S\n]*\n?(.*)\z"
    rows = parts.filter(F.col("part").rlike(head)).select(source, F.regexp_extract("part", head, 2).alias("url"), "ord", F.regexp_extract("part", head, 1).alias("title"), F.regexp_extract("part", head, 3).alias("body"))
    return R.last_wins(rows, [source, "url"], ["ord"])


_TREE = "truncated boolean, tree array<struct<type:string,path:string,sha:string>>"


def tree_files(trees: DataFrame, prefixes: Sequence[str], suffixes: Sequence[str], extra: Sequence[str] = (), source: str = "source", body: str = "json") -> DataFrame:
    """(source, path, sha, truncated) of a repository tree's blobs below prefixes with one of suffixes, and the extra paths."""
    rows = trees.select(source, F.from_json(body, _TREE).alias("t")).select(source, F.col("t.truncated").alias("truncated"), F.explode("t.tree").alias("b"))
    held = F.lit(False)
    for p in prefixes:
        held = held | F.col("b.path").startswith(p)
    ends = F.lit(False)
    for s in suffixes:
        ends = ends | F.col("b.path").endswith(s)
    wanted = (held & ends) | F.col("b.path").isin(*extra) if extra else held & ends
    return rows.filter((F.col("b.type") == "blob") & wanted).select(source, F.col("b.path").alias("path"), F.col("b.sha").alias("sha"), F.coalesce("truncated", F.lit(False)).alias("truncated"))


_WIKI = "struct<query:struct<pages:array<struct<title:string,lastrevid:bigint,missing:boolean,revisions:array<struct<revid:bigint,slots:struct<main:struct<content:string>>,content:string>>,categories:array<struct<title:string>>>>>,continue:map<string,string>,error:struct<code:string>>"


def wiki_pages(replies: DataFrame, batch: str = "batch", body: str = "json") -> tuple[DataFrame, DataFrame]:
    """((title, revision, content, categories), batches): replies with continuations merged by title; pages without content go.

    batches has (batch, failed): an error, or a reply that can't be read, fails its batch.
    """
    parsed = replies.select(batch, F.from_json(body, _WIKI).alias("r"))
    batches = parsed.groupBy(batch).agg(F.bool_or(F.col("r").isNull() | F.col("r.query").isNull() | F.col("r.error").isNotNull()).alias("failed"))
    rows = parsed.select(F.posexplode("r.query.pages").alias("ord", "p"))
    rev = F.get("p.revisions", F.lit(0))
    merged = rows.groupBy(F.col("p.title").alias("title")).agg(
        F.max(F.coalesce(rev["revid"], F.col("p.lastrevid"))).alias("revision"), F.first(F.coalesce(rev["slots"]["main"]["content"], rev["content"]), ignorenulls=True).alias("content"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform("p.categories", lambda c: F.regexp_replace(c["title"], "^Category:", "")))))).alias("categories"))
    return merged.filter("content IS NOT NULL"), batches


def paged(first: DataFrame, source: str = "source", total: str = "total_pages") -> DataFrame:
    """(source, page): the pages after the first that have to be asked for."""
    return first.filter(F.col(total) > 1).select(source, F.explode(F.sequence(F.lit(2), F.col(total).cast("int"))).alias("page"))


def json_directory(replies: DataFrame, fields: str, items: str = "items", key: str = "id", body: str = "json") -> DataFrame:
    """Rows of a directory reply's items (fields is their struct's DDL), of a key the last."""
    rows = replies.select(F.posexplode(F.from_json(body, f"struct<{items}:array<struct<{fields}>>>")[items]).alias("ord", "item")).select("ord", "item.*")
    return R.last_wins(rows, [key], ["ord"]).drop("ord")


def valid_documents(docs: DataFrame, kind: str, body: str = "json") -> DataFrame:
    """Documents that parse and whose kind is the one wanted."""
    return docs.filter(F.try_variant_get(F.try_parse_json(body), "$.kind", "string") == kind)


def sidebar(pages: DataFrame, prefix: str, source: str = "source", html: str = "html") -> DataFrame:
    """(source, ord, grp, slug, title): links below prefix in order, under the last group name; of a slug the first."""
    token = r"""(?is)<(?:summary|h[2-6]|span)\b[^>]*class="[^"]*(?:group|large|category)[^"]*"[^>]*>.*?</(?:summary|h[2-6]|span)>|<a\b[^>]*href="[^"]*"[^>]*>.*?</a>"""
    rows = pages.select(source, F.posexplode(F.regexp_extract_all(html, F.lit(token), F.lit(0))).alias("ord", "token"))
    text = T.collapsed(T.unescaped(F.regexp_replace("token", "<[^>]*>", " ")))
    link = F.col("token").rlike("(?i)^<a")
    rows = R.running_value(rows.withColumn("text", text), source, "ord", F.when(~link, F.col("text")), "grp")
    href = F.regexp_extract("token", r'href="([^"]*)"', 1)
    slug = F.regexp_replace(F.regexp_replace(href, r"[?#].*$", ""), rf"^(?:https?://[^/]+)?\Q{prefix}\E/?|/+$", "")
    rows = rows.filter(link & F.regexp_replace(href, r"^https?://[^/]+", "").startswith(prefix)).select(source, "ord", "grp", slug.alias("slug"), F.col("text").alias("title"))
    return R.first_wins(rows, [source, "slug"], ["ord"])


def english_paths(urls: DataFrame, prefix: str, url: str = "url", default: Sequence[str] = ()) -> DataFrame:
    """urls below prefix without those of a locale: a first segment that also stands bare as prefix/segment/ with pages below it."""
    path = F.regexp_replace(F.regexp_replace(F.col(url), r"^https?://[^/]+", ""), r"[?#].*$|/+$", "")
    rows = urls.withColumn("__rest", F.when(path.startswith(prefix), F.regexp_replace(path, rf"^\Q{prefix}\E/?", ""))).filter("__rest IS NOT NULL").withColumn("__seg", F.get(F.split("__rest", "/"), F.lit(0)))
    locales = rows.groupBy("__seg").agg(F.bool_or(F.col("__rest") == F.col("__seg")).alias("bare"), F.bool_or(F.col("__rest") != F.col("__seg")).alias("deep"))
    locales = locales.filter(F.col("bare") & F.col("deep") & F.col("__seg").rlike(r"^[a-z]{2}(?:-[a-zA-Z]{2,4})?$") & ~F.col("__seg").isin(*default, "")).select(F.col("__seg").alias("__loc"))
    return rows.join(locales, F.col("__seg") == F.col("__loc"), "left_anti").drop("__rest", "__seg")


def navigation(navs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, ord, depth, parents, title, page) of nested `- Title: page.md` lists under `nav:`, by their indents."""

    def run(frames):
        for frame in frames:
            rows = []
            for key, value in zip(frame[source], frame[text], strict=True):
                inside, stack = False, []
                for line in (value or "").split("\n"):
                    if re.match(r"^nav:\s*$", line):
                        inside = True
                    elif inside and line.strip() and not line.startswith((" ", "-", "\t")):
                        break
                    elif inside and (found := re.match(r"""^(\s*)-\s+(?:["']?(.+?)["']?:\s*)?(\S+\.mdx?|https?://\S+)?\s*$""", line)):
                        indent = len(found[1])
                        stack = [s for s in stack if s[0] < indent]
                        rows.append((key, len(rows), len(stack), [s[1] for s in stack], found[2] or "", found[3]))
                        if not found[3]:
                            stack.append((indent, found[2] or ""))
            yield pd.DataFrame(rows, columns=[source, "ord", "depth", "parents", "title", "page"])

    kind = navs.schema[source].dataType.simpleString()
    return navs.select(source, text).mapInPandas(run, f"`{source}` {kind}, ord int, depth int, parents array<string>, title string, page string")


def sphinx_names(indexes: DataFrame, source: str = "source", script: str = "script") -> DataFrame:
    """(source, ord, name) of the docnames in a search index script."""
    names = F.from_json(F.regexp_extract(script, r"(?s)\"?docnames\"?\s*:\s*(\[.*?\])", 1), "array<string>")
    return indexes.select(source, F.posexplode(names).alias("ord", "name"))


def toctree_edges(docs: DataFrame, name: str = "name", text: str = "text") -> DataFrame:
    """(src, ord, caption, title, dst) of every toctree entry."""
    from ..functions import rst_md

    @F.pandas_udf("array<struct<caption:string,title:string,dst:string>>")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([[(t["caption"], a, b) for t in rst_md.toctrees(v or "") for a, b in t["entries"]] for v in values])

    return docs.select(F.col(name).alias("src"), F.posexplode(run(text)).alias("ord", "e")).select("src", "ord", "e.*")


def _matches(scripts: DataFrame, source: str, script: str | Column, pattern: str, *names: str) -> DataFrame:
    """(source, ord, one column for each group) of all matches of pattern."""
    rows = scripts.select(source, F.posexplode(F.regexp_extract_all(script, F.lit(pattern), F.lit(0))).alias("ord", "__m"))
    return rows.select(source, "ord", *[F.regexp_extract("__m", pattern, k + 1).alias(n) for k, n in enumerate(names)])


def script_urls(pages: DataFrame, source: str = "source", html: str = "html") -> DataFrame:
    """(source, ord, url) of the scripts that a page loads."""
    return _matches(pages, source, html, r"""src=["']([^"']+\.js)["']""", "url")


def script_routes(scripts: DataFrame, source: str = "source", script: str = "script") -> dict[str, DataFrame]:
    """The tables inside a bundler's main script: routes (route, chunk), contents (key, content), loaders (content, chunks, module, file).

    A route's component is a call whose last argument is its chunk; `route-chunk` is the key of its content; a content's
    loader lists the chunks it needs, the module and the file that it was made from. See route_contents().
    """
    loader = r"""["']?([\w$-]+)["']?:\[((?:[^\[\]]|\[[^\[\]]*\])*)\]"""
    loaders = _matches(scripts, source, script, loader, "content", "loader")
    return {
        "routes": _matches(scripts, source, script, r"""path:\s*["']([^"']+)["'],\s*component:\s*\w+\((?:[^()]*,\s*)?["']([^"']+)["']\)""", "route", "chunk"),
        "contents": _matches(scripts, source, script, r"""["']([^"']+)["']:\{[^{}]*["']content["']:\s*["']([^"']+)["']""", "key", "content"),
        "loaders": loaders.select(
            source, "content", F.regexp_extract_all("loader", F.lit(r"\.e\((\d+)\)"), F.lit(1)).alias("chunks"),
            F.nullif(F.regexp_extract("loader", r"\.bind\(\w+,\s*(\d+)\)", 1), F.lit("")).alias("module"), F.nullif(F.regexp_extract("loader", r"""["'](@site/[^"']+)["']""", 1), F.lit("")).alias("file")).filter("size(chunks) > 0"),
    }


def chunk_files(runtimes: DataFrame, source: str = "source", script: str = "script") -> DataFrame:
    """(source, chunk, file): `folder/name.hash.js` from the function that names chunks, told by its place in the runtime script.

    The function's first map has names, its second hashes; a chunk that one of them lacks stands there by its number.
    """
    body = F.regexp_extract(script, r"""(?s)\.u\s*=\s*\w+\s*=>(.*?)(?:,\s*\w+\.\w+\s*=|;|\z)""", 1)
    folder = F.regexp_extract(body, r"""^\s*["']([^"']*)["']""", 1)
    maps = F.regexp_extract_all(body, F.lit(r"\{([^{}]*)\}\[\w+\]"), F.lit(1))
    rows = runtimes.select(source, folder.alias("folder"), maps.alias("maps")).filter("size(maps) > 1")
    entry = r"""(\d+)\s*:\s*["']([^"']+)["']"""
    names, hashes = (_matches(rows.withColumn("__map", F.get("maps", F.lit(k))), source, "__map", entry, "chunk", kind).drop("ord") for k, kind in ((0, "name"), (1, "hash")))
    files = names.join(hashes, [source, "chunk"], "full").join(rows.select(F.col(source).alias("__s"), "folder"), F.col(source).eqNullSafe(F.col("__s")))
    return files.select(source, "chunk", F.concat("folder", F.coalesce("name", "chunk"), F.lit("."), F.coalesce("hash", "chunk"), F.lit(".js")).alias("file"))


def route_contents(scripts: DataFrame, runtimes: DataFrame, source: str = "source", script: str = "script") -> DataFrame:
    """(source, route, module, made_from, file): a chain of equi-joins from each route to the script that has its content.

    Of the chunks that a content needs, the last is its own; the others are shared.
    """
    t = script_routes(scripts, source, script)
    keyed = t["routes"].select(source, "route", F.concat_ws("-", "route", "chunk").alias("key"))
    found = keyed.join(t["contents"].select(source, "key", "content").distinct(), [source, "key"]).join(t["loaders"], [source, "content"])
    own = found.select(source, "route", "module", F.col("file").alias("made_from"), F.element_at("chunks", -1).alias("chunk")).distinct()
    return own.join(chunk_files(runtimes, source, script), [source, "chunk"]).drop("chunk")


def page_data(pages: DataFrame, key: str = "url", body: str = "json") -> DataFrame:
    """(url, title, description, script) of page-data replies with compiled content."""
    v = F.try_parse_json(body)
    text = lambda path: F.try_variant_get(v, path, "string")
    return pages.select(key, F.coalesce(text("$.pageProps.pageTitle"), text("$.pageProps.source.frontmatter.title")).alias("title"), text("$.pageProps.source.frontmatter.description").alias("description"), text("$.pageProps.source.compiledSource").alias("script"))


def embedded_object(pages: DataFrame, field: str, wanted: str, attribute: str = "data-page", html: str = "html", key: str = "url") -> DataFrame:
    """(url, json): the first object, at most ten levels deep, whose field is wanted, in JSON inside an attribute of the page."""
    from html import unescape

    from ..functions import spec_md

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        out = []
        for v in values:
            found = None
            for m in re.findall(rf"""{attribute}=(?:"([^"]*)"|'([^']*)')""", v or ""):
                try:
                    found = found or spec_md.find_object(json.loads(unescape(m[0] or m[1])), field, wanted)
                except ValueError:
                    continue
            out.append(None if found is None else json.dumps(found, sort_keys=True))
        return pd.Series(out, dtype="object")

    return pages.select(key, run(html).alias("json"))


def fresh(landed: DataFrame, hours: int = 24, at: str = "fetched_at", now: Column | None = None) -> DataFrame:
    """Landed rows that are younger than hours."""
    return landed.filter(F.col(at) > (F.current_timestamp() if now is None else now) - F.make_interval(hours=F.lit(hours)))


def first_valid(candidates: DataFrame, source: str = "source", order: str = "ord", body: str = "json") -> DataFrame:
    """Of a fallback chain, the first candidate that is JSON with paths, or a list."""
    v = F.try_parse_json(body)
    good = candidates.filter(v.isNotNull() & (F.try_variant_get(v, "$.paths", "variant").isNotNull() | F.schema_of_variant(v).startswith("ARRAY")))
    return R.first_wins(good, [source], [order])


def batched(titles: DataFrame, size: int = 50, key: str = "title") -> DataFrame:
    """(title, batch): requests of size titles, in order; by ranges, so no task orders all titles."""
    return R.batches(titles, None, key, size)
