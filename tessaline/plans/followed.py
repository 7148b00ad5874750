"""Queries over runs whose requests follow from replies: sources by name, twice over landed sites of their shape, some of them failing."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import convert as V
from ..functions import text as T
from ..operators import documents as P
from ..operators import graph as G
from ..sources import discover as D
from ..sources import requests as Q
from ..sources.registry import SOURCES, SourceSpec
from . import run
from .landed import _f, _states, _whole
from .registry import _t, query
from .store import Pile, SnapshotStore, cut_here, own_path
from .sync import Options, synchronise

def _pages(rows: DataFrame, url, body, etag=None, status=None) -> DataFrame:
    return rows.select(url.alias("url"), body.alias("body"), (F.lit(None).cast("string") if etag is None else etag).alias("etag"), (F.lit(200) if status is None else status).cast("int").alias("status"))


def _site(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut_here(out)


def _one(rows: DataFrame, url: str, item, before="", between="", after="", status=200) -> DataFrame:
    """A text at url made of all rows, in the order of nations."""
    text = _whole(rows, F.lit("x"), "n_nationkey", item, before, between, after)
    return _pages(text, F.lit(url), F.col("text"), status=F.lit(status))


class _Logged:
    """A way to fetch that keeps what was asked for and how it was answered."""

    def __init__(self, site: DataFrame):
        self.get, self.log = run.landed(site), Pile(site.sparkSession, site.sparkSession.createDataFrame([], "url string, etag string, status int").schema)

    def __call__(self, asked: DataFrame) -> DataFrame:
        got = cut_here(self.get(asked))
        self.log.add(asked.select("url", "etag").join(got.select(F.col("url").alias("u"), "status"), F.col("url") == F.col("u")))
        return got


def _kept(store: SnapshotStore, out) -> DataFrame:
    """(key, status) after a run: of what the run says nothing of, 'kept' if the state has it still."""
    state = store.read().select("key").join(out.rows.select(F.col("key").alias("__k")), F.col("key") == F.col("__k"), "left_anti")
    return out.rows.select("key", "status").unionByName(state.select("key", F.lit("kept").alias("status")))


def _runs(spark, spec: SourceSpec, *sites: DataFrame, **more) -> DataFrame:
    store = SnapshotStore(spark, own_path(spark, f"source-{spec.name}"))
    out = None
    for site in sites:
        out = run.run_source(spark, spec, store, run.landed(site), **more)
    return _kept(store, out)


_CHANGED = "CASE WHEN n_regionkey = 0 THEN 'added' WHEN n_regionkey = 3 THEN 'removed' WHEN n_regionkey = 1 THEN 'updated' WHEN n_regionkey = 2 THEN 'kept' ELSE 'unchanged' END AS status FROM nation"


@query(f"SELECT 'docs/' || n_name || '.md' AS key, {_CHANGED}")
def source_of_shards(spark, d):
    """A sitemap that names sitemaps, one for each region, twice: the second time one of them fails, one is gone, one new."""
    spec = SOURCES["google-cloud"]
    host = spec.url.rsplit("/", 1)[0]

    def site(rows, fails):
        names = rows.dropDuplicates(["n_regionkey"])
        shards = _whole(rows, F.col("n_regionkey").cast("string"), "n_nationkey", _f(f"<url><loc>{host}/docs/%</loc><lastmod>2024%</lastmod></url>", "n_name", "mark"), "<urlset>", "", "</urlset>")
        return _site(
            _one(names, spec.url, _f(f"<sitemap><loc>{host}/s%.xml</loc></sitemap>", "n_regionkey"), "<sitemapindex>", "", "</sitemapindex>"),
            _pages(shards, _f(f"{host}/s%.xml", "source"), F.col("text"), status=F.when(F.lit(fails) & (F.col("source") == "2"), 500).otherwise(200)),
            _pages(rows, _f(f"{host}/docs/%", "n_name"), _f('<title>% | C</title><div class="devsite-article-body"><p>Text%</p></div>', "n_name", "mark")))

    first, second = _states(spark, d, "T1")
    return _runs(spark, spec, site(first, False), site(second, True))


@query(f"SELECT 't' || CAST(n_regionkey AS VARCHAR) || '/get-' || replace(lower(n_name), '_', '-') || '.md' AS key, {_CHANGED}")
def source_of_scopes(spark, d):
    """Two descriptions: the second time one answers 500 and the other has lost, changed and added operations; only the other's are removed."""
    spec = SourceSpec("scopes", "fixed", ("openapi",), "endpoint_documents", "https://s.test/a.json", failure="scope", also=("https://s.test/b.json",))
    item = _f('"/%":{"get":{"summary":"Get %%","tags":["T%"]}}', "n_name", "n_name", "mark", "n_regionkey")
    text = lambda rows, url, status=200: _one(rows, url, item, '{"openapi":"3.0.0","paths":{', ",", "}}", status)
    first, second = _states(spark, d, "!")
    site = lambda rows, status: _site(text(rows.filter("n_regionkey = 2"), spec.url, status), text(rows.filter("n_regionkey <> 2"), spec.also[0]))
    return _runs(spark, spec, site(first, 200), site(second, 500))


@query("SELECT 'docs/' || n_name || '.md' AS key, CASE WHEN n_regionkey < 2 THEN 'unchanged' ELSE 'kept' END AS status FROM nation WHERE n_regionkey <> 3 UNION ALL SELECT 'docs/' || n_name || '.md', 'kept' FROM nation WHERE n_regionkey = 3")
def source_of_error_page(spark, d):
    """Two indexes: the second time one answers 200 with an error page, which closes its part's gate."""
    spec = SourceSpec("index", "sitemap_by_path", ("html",), "html_to_markdown", "https://e.test/a.xml", also=("https://e.test/b.xml",))
    rows = _t(spark, d, "nation")
    index = lambda part, url: _one(part, url, _f("<url><loc>https://e.test/docs/%</loc></url>", "n_name"), "<urlset>", "", "</urlset>")
    pages = _pages(rows, _f("https://e.test/docs/%", "n_name"), _f("<main><p>%</p></main>", "n_name"))
    a = index(rows.filter("n_regionkey < 2"), spec.url)
    error = _pages(rows.limit(1), F.lit(spec.also[0]), F.lit("<html><body>try again later</body></html>"))
    return _runs(spark, spec, _site(a, index(rows.filter("n_regionkey >= 2"), spec.also[0]), pages), _site(a, error, pages))


@query("SELECT 'docs/' || n_name || '.md' AS key, CASE WHEN n_regionkey = 1 THEN 'preserved' WHEN n_regionkey = 2 THEN 'kept' ELSE 'unchanged' END AS status FROM nation UNION ALL SELECT 'docs.md', 'unchanged'")
def source_of_failing_crawl(spark, d):
    """A crawl below its first page: the second time region 1 answers 500, so what only it links to (region 2) is not seen, and nothing goes."""
    spec = SourceSpec("crawl", "reachable", ("html",), "html_to_markdown:jekyll", "https://f.test/docs/")
    rows = _t(spark, d, "nation")
    frame = lambda inner: _f('<section class="text-content">%</section>', inner)
    link = _f('<a href="/docs/%">%</a>', "n_name", "n_name")
    below = _whole(rows.filter("n_regionkey = 2"), F.lit("x"), "n_nationkey", link).select(F.col("text").alias("below"))
    every = rows.join(F.broadcast(below))  # one row
    more = F.when(F.col("n_regionkey") == 1, F.col("below")).otherwise(F.lit('<a href="/blog/no">out</a>'))
    page = lambda status: _pages(every, _f("https://f.test/docs/%", "n_name"), frame(_f("<h1>%</h1>%", "n_name", more)), status=status)
    top = _whole(rows.filter("n_regionkey <> 2"), F.lit("x"), "n_nationkey", link)
    root = _pages(top, F.lit(spec.url), frame(F.col("text")))
    return _runs(spark, spec, _site(root, page(F.lit(200))), _site(root, page(F.when(F.col("n_regionkey") == 1, 500).otherwise(200))))


@query("SELECT 'https://v.test/' || n_name || '.md' AS url, CAST(CASE WHEN n_regionkey = 1 THEN 200 ELSE 304 END AS INTEGER) AS status, n_regionkey > 1 AS probed FROM nation WHERE n_regionkey > 0 AND n_regionkey < 3 UNION ALL SELECT 'https://v.test/' || n_name || '.md', 200, false FROM nation WHERE n_regionkey = 3")
def conditional_requests(spark, d):
    """What a second run asks for again and how it is answered: pages with an ETag say 304 unless they changed; those without have their bodies fetched.

    The same source with a look at validators first asks only for what has another ETag; probed says which requests that spares.
    """
    spec = SourceSpec("etags", "link_index", ("markdown",), "without_front_matter", "https://v.test/llms.txt", token="etag")
    rows = _t(spark, d, "nation").filter("n_regionkey > 0 AND n_regionkey < 4")
    index = _one(rows, spec.url, _f("- [%](/%.md)", "n_name", "n_name"), "", "\n")

    def site(mark):
        changed = F.when(F.col("n_regionkey") == 1, F.lit(mark)).otherwise(F.lit(""))
        return _site(index, _pages(rows, _f("https://v.test/%.md", "n_name"), _f("# %\n%\n", "n_name", changed), F.when(F.col("n_regionkey") < 3, _f('"%%"', "n_name", changed))))

    asked = []
    for probe in (False, True):
        own, store = replace(spec, probe=probe), SnapshotStore(spark, own_path(spark, "etags"))
        head = lambda s: lambda a: run.landed(s)(a).withColumn("body", F.lit(None).cast("binary"))
        run.run_source(spark, own, store, run.landed(one := site("")), head=head(one))
        get = _Logged(two := site("!"))
        run.run_source(spark, own, store, get, head=head(two))
        asked.append(get.log.read().filter(F.col("url") != spec.url).select("url", "status"))
    plain, probed = asked
    return plain.join(probed.select(F.col("url").alias("u")), F.col("url") == F.col("u"), "left").select("url", "status", F.col("u").isNull().alias("probed"))


@query("""SELECT run, 'https://registry.terraform.io/v2/provider-docs/' || CAST(n_nationkey AS VARCHAR) AS url FROM nation, (VALUES (1), (2), (3)) v(run)
WHERE run = 1 OR (run = 2 AND n_regionkey IN (1, 2)) OR (run = 3 AND n_nationkey = (SELECT max(n_nationkey) FROM nation WHERE n_regionkey = 2))""".replace("SELECT run,", "SELECT CAST(run AS INTEGER) AS run,"))
def registry_requests(spark, d):
    """The documents that three runs of a registry ask for. Second: region 1 has a new version, region 2 too, and one of its documents fails.
    Third: only region 2 is listed again, as its fingerprint does not count until all of it has come, and of it what failed is asked for."""
    spec = SOURCES["terraform"]
    root, rows = "https://registry.terraform.io", _t(spark, d, "nation")
    store, out = SnapshotStore(spark, own_path(spark, "registry")), None
    for number in (1, 2, 3):
        newer = F.when(F.lit(number > 1) & F.col("n_regionkey").isin(1, 2), F.lit("2")).otherwise(F.lit("1"))
        named = rows.dropDuplicates(["n_regionkey"])
        providers = named.filter("n_regionkey < 3"), named.filter("n_regionkey >= 3")
        page = lambda part, url: _one(part, url, _f('{"attributes":{"full-name":"org/r%"}}', "n_regionkey"), '{"meta":{"pagination":{"total-pages":2}},"data":[', ",", "]}")
        docs = _whole(rows, F.col("n_regionkey").cast("string"), "n_nationkey", _f('{"id":"%","category":"c","slug":"%","title":"%"}', "n_nationkey", "n_name", "n_name"), '{"docs":[', ",", "]}")
        fails = F.lit(number == 2) & (F.col("n_regionkey") == 2) & (F.col("n_nationkey") == F.col("__most"))
        most = rows.groupBy(F.col("n_regionkey").alias("__r")).agg(F.max("n_nationkey").alias("__most"))
        bodies = rows.join(most, F.col("n_regionkey") == F.col("__r"))
        site = _site(
            page(providers[0], spec.url), page(providers[1], f"{spec.url}&page[number]=2"), _pages(named, _f(f"{root}/v1/providers/org/r%", "n_regionkey"), _f('{"version":"%"}', newer)),
            _pages(docs.withColumn("n_regionkey", F.col("source").cast("int")), _f(f"{root}/v1/providers/org/r%/%", "source", newer), F.col("text")),
            _pages(bodies, _f(f"{root}/v2/provider-docs/%", "n_nationkey"), _f('{"data":{"attributes":{"content":"---\\\\na: 1\\\\n---\\\\n# % %"}}}', "n_name", newer), status=F.when(fails, 500).otherwise(200)))
        get = _Logged(site)
        run.run_source(spark, spec, store, get)
        asked = get.log.read().filter(F.contains("url", F.lit("/provider-docs/"))).select("url").distinct().select(F.lit(number).alias("run"), "url")
        out = asked if out is None else out.unionByName(asked)
    return out


@query("""SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN (row_number() OVER (ORDER BY CAST(doc_id AS VARCHAR)) - 1) // 50 % 3 = 1 THEN 'failed' WHEN doc_id % 7 = 0 THEN 'missing' ELSE 'found' END AS outcome FROM documents""")
def batched_keys(spark, d):
    """Keys asked for fifty at a time, with a continuation for each request; of every third batch the continuation fails."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), "doc_id")
    held = cut_here(D.batched(docs, 50, "key"))
    groups = held.groupBy("batch").agg(F.array_sort(F.collect_list("key")).alias("keys"))  # fifty at most
    url = Q.wiki_url("https://w.test/api.php", action="query")
    entry = F.to_json(F.struct(F.col("key").alias("title")))
    first = _whole(held.filter("doc_id % 2 = 0 AND doc_id % 7 > 0"), F.col("batch").cast("string"), "key", entry, "", ",", "", "a")
    second = _whole(held.filter("doc_id % 2 = 1 AND doc_id % 7 > 0"), F.col("batch").cast("string"), "key", entry, "", ",", "", "b").withColumnRenamed("source", "source2")
    both = groups.join(first, F.col("batch").cast("string") == F.col("source"), "left").join(second, F.col("batch").cast("string") == F.col("source2"), "left").withColumn("url", url(F.col("keys")))
    one = _pages(both, F.col("url"), _f('{"continue":{"clcontinue":"2|x","continue":"||"},"query":{"pages":[%]}}', F.coalesce("a", F.lit(""))))
    two = _pages(both, F.concat("url", F.lit("&clcontinue=2%7Cx")), _f('{"query":{"pages":[%]}}', F.coalesce("b", F.lit(""))), status=F.when(F.col("batch") % 3 == 1, 503).otherwise(200))
    replies, batches = Q.in_batches(docs, run.landed(_site(one, two)), url, Q.continued)
    kind = "struct<query:struct<pages:array<struct<title:string>>>>"
    found = replies.filter("status = 200").select(F.explode(F.from_json("body", kind)["query"]["pages"]["title"]).alias("key"))
    failed = batches.filter("failed").select(F.explode("keys").alias("bad"))
    told = Q.outcome_by_key(batches, found)
    # A batch that lost its continuation is not whole: what it found does not count either.
    return told.join(failed, F.col("key") == F.col("bad"), "left").select("key", F.when(F.col("bad").isNotNull(), "failed").otherwise(F.col("outcome")).alias("outcome"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS key, source = 'src5' AS gone FROM documents WHERE lang = 'fr' OR source = 'src5'""")
def written_by_a_run(spark, d):
    """The rows that a second run's commit has: what changed and what is gone, nothing else."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), F.coalesce("text", F.lit("")).alias("text"), "lang", "source")
    new = docs.filter("source <> 'src5'").withColumn("text", F.when(F.col("lang") == "fr", F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    store = SnapshotStore(spark, own_path(spark, "delta"), most=1000)
    store.size = lambda name: 0  # no folding here: the delta itself is looked at
    for site in (docs, new):
        bodies = site.select("key", F.lit(200).alias("status"), F.col("text").alias("body"))
        fetch = lambda wanted, bodies=bodies: bodies.join(wanted.select("key").hint("shuffle_hash"), "key", "left_semi")
        convert = lambda rows: rows.select("key", F.lit("").alias("title"), F.col("body").alias("content"))
        out = synchronise(site.select("key", T.content_hash("text").alias("token")), fetch, convert, store, Options())
    return spark.read.parquet(f"{store.root}/{out.version}").select("key", F.col("__gone").alias("gone"))


@query("""SELECT CASE WHEN n_nationkey % 2 = 0 THEN 't' || CAST(n_regionkey AS VARCHAR) || '/get-' || replace(lower(n_name), '_', '-') || '.md' ELSE 'docs/' || n_name || '.md' END AS key,
CASE WHEN n_regionkey = 0 THEN 'added' WHEN n_regionkey = 3 THEN 'removed' WHEN n_regionkey = 1 THEN 'updated' WHEN n_regionkey = 2 THEN 'kept' ELSE 'unchanged' END AS status FROM nation""")
def source_of_bundles(spark, d):
    """A page whose scripts name chunks that are fetched in turn; even nations are packed descriptions, odd ones compiled components. The second time region 2's chunks fail."""
    spec = SOURCES["rippling"]
    host = spec.url.split("/documentation")[0]

    @F.pandas_udf("string")
    def packed(values):
        from base64 import b64encode
        from zlib import compress

        return values.map(lambda t: b64encode(compress(t.encode())).decode())

    def site(rows, fails):
        k = "n_nationkey"
        main = _f('path:"/docs/%",component:p("@layout","c%"),"/docs/%-c%":{"args":"x","content":"t%"},"t%":[()=>Promise.all([n.e(9),n.e(%)]).then(n.bind(n,%)),"@site/%.mdx",%]', "n_name", k, "n_name", k, k, k, F.col(k) + 100, F.col(k) + 1000, "n_name", k)
        hashes = _f('%:"h%"', F.col(k) + 100, k)
        spec_ = packed(_f('{"openapi":"3.0.0","paths":{"/%":{"get":{"summary":"Get %%","tags":["T%"]}}}}', "n_name", "n_name", "mark", "n_regionkey"))
        compiled = _f('"use strict";function _createMdxContent(props){const _components={h1:"h1",p:"p",...props.components};return _jsxs(_Fragment,{children:[_jsx(_components.h1,{children:"%"}),"\\n",_jsx(_components.p,{children:"text%"})]})}', "n_name", "mark")
        body = F.when(F.col(k) % 2 == 0, F.concat(F.lit('"use strict";(self.w=self.w||[]).push([[1],{1:(e)=>{e.exports={api:"'), spec_, F.lit('"}}}])'))).otherwise(compiled)
        none = rows.filter("n_nationkey < 0").count() == 0
        page = '<script src="/assets/js/runtime~main.1.js"></script><script src="/assets/js/main.2.js"></script>'
        return _site(
            _pages(rows.limit(1), F.lit(spec.url), F.lit(page)), _one(rows, f"{host}/assets/js/main.2.js", main, "x={", ",", "}"),
            _one(rows, f"{host}/assets/js/runtime~main.1.js", hashes, 'q.u=e=>"assets/js/"+({}[e]||e)+"."+({', ",", '}[e]||e)+".js",q.x=1'),
            _pages(rows, _f(f"{host}/assets/js/%.h%.js", F.col(k) + 100, k), body, status=F.when(F.lit(fails and none) & (F.col("n_regionkey") == 2), 500).otherwise(200)))

    first, second = _states(spark, d, "!")
    return _runs(spark, spec, site(first, False), site(second, True))


_NL = "chr(10)"


@query(f"""SELECT 'm' AS source, 'p' || CAST(r.n_regionkey AS VARCHAR) || '.md' AS path, 'Part ' || CAST(r.n_regionkey AS VARCHAR) AS title, '# Part ' || CAST(r.n_regionkey AS VARCHAR) || {_NL} || {_NL} || 'See [first](p' || CAST(r.n_regionkey AS VARCHAR) || '/' || lower(r.name) || '.md#' || r.name || ').' || {_NL} AS markdown
FROM (SELECT n_regionkey, arg_min(n_name, n_nationkey) AS name FROM nation GROUP BY 1) r
UNION ALL SELECT 'm', 'p' || CAST(a.n_regionkey AS VARCHAR) || '/' || lower(a.n_name) || '.md', a.n_name, '## ' || a.n_name || {_NL} || {_NL} || 'Next [one](' || CASE WHEN a.n_regionkey = b.n_regionkey THEN '' ELSE '../p' || CAST(b.n_regionkey AS VARCHAR) || '/' END || lower(b.n_name) || '.md#' || b.n_name || '), [own](#' || a.n_name || '), [lost](#nowhere).' || {_NL}
FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey + 1) % 25""")
def sliced_manual(spark, d):
    """One page of parts and of chapters that follow them, cut into documents; links to anchors lead to the documents that have them now."""
    rows = _t(spark, d, "nation").select("*", F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).alias("k"))
    names = _t(spark, d, "nation").select(F.col("n_nationkey").alias("__n"), F.col("n_name").alias("next"))
    rows = rows.join(names, (F.col("n_nationkey") + 1) % 25 == F.col("__n"))
    part = _f('<div class="part"><h1 id="p%">Part %</h1><p>See <a href="#%">first</a>.</p></div>', "n_regionkey", "n_regionkey", "n_name")
    chapter = _f('<div class="chapter"><h2 id="%">%</h2><p>Next <a href="#%">one</a>, <a href="#%">own</a>, <a href="#nowhere">lost</a>.</p></div>', "n_name", "n_name", "next", "n_name")
    ordered = rows.withColumn("at", F.col("n_regionkey") * 1000 + F.col("k"))
    page = _whole(ordered, F.lit("m"), "at", F.concat(F.when(F.col("k") == 1, part).otherwise(F.lit("")), chapter), "<html><body>", "", "</body></html>", "html")
    return P.relinked(P.sliced(page, [["part"], ["chapter"]])).select("source", "path", "title", "markdown")


@query("""WITH RECURSIVE w AS (SELECT 0 AS id, 0 AS depth, '00' AS place UNION ALL SELECT 2 * w.id + k, depth + 1, place || CAST(k AS VARCHAR) FROM w, (VALUES (1), (2)) v(k) WHERE 2 * w.id + k < 25)
SELECT 'n' || CAST(id AS VARCHAR) AS node, depth, CAST(row_number() OVER (ORDER BY place) AS BIGINT) AS number, CASE WHEN id > 0 THEN CASE WHEN id % 2 = 1 THEN 'Left' ELSE 'Right' END END AS caption FROM w""")
def toctree_reading_order(spark, d):
    """Nations as a binary tree of toctrees, whose entries also lead back to the root and across: the order in which a reader meets them."""
    k = F.col("n_nationkey")
    block = lambda caption, child, back: F.concat(F.lit(f".. toctree::\n   :caption: {caption}\n\n"), F.when(child < 25, _f("   n%\n", child)).otherwise(F.lit("")), _f("   %\n\n", back))
    text = F.concat(F.lit("T\n=\n\n"), block("Left", 2 * k + 1, F.lit("n0")), block("Right", 2 * k + 2, _f("n%", k)))
    edges = D.toctree_edges(_t(spark, d, "nation").select(_f("n%", "n_nationkey").alias("name"), text.alias("text")))
    order = G.reading_order(edges, spark.createDataFrame([("n0", 0)], "node string, ord int"))
    return order.select("node", "depth", "number", "caption")


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'openapi' WHEN 1 THEN 'html' WHEN 2 THEN 'compiled' WHEN 3 THEN 'mdx' WHEN 4 THEN 'openapi' ELSE 'markdown' END AS kind FROM documents")
def body_kinds(spark, d):
    """What each body is, told from the body: descriptions as JSON and YAML, pages, compiled and plain components, plain text."""
    k, text = F.col("doc_id") % 6, F.regexp_replace(F.coalesce("source", F.lit("")), "[^a-z0-9]", "")
    body = (F.when(k == 0, _f('{"openapi":"3.0.0","info":{"title":"%"},"paths":{}}', text)).when(k == 1, _f("<!doctype html><p>%</p>", text)).when(k == 2, _f("function _createMdxContent(props){return '%'}", text))
            .when(k == 3, _f("import X from 'x'\n\n<Note>%</Note>\n", text)).when(k == 4, _f("openapi: 3.0.0\ninfo:\n  title: %\npaths: {}\n", text)).otherwise(_f("# %\n\ntext\n", text)))
    return _t(spark, d, "documents").select("doc_id", V.body_kind(body).alias("kind"))


@query(f"""SELECT 'r' || CAST(n_regionkey AS VARCHAR) || '/README.md' AS key, '# r' || CAST(n_regionkey AS VARCHAR) || {_NL} || {_NL} || CAST(count(*) AS VARCHAR) || ' pages.' || {_NL} || {_NL} || string_agg('- [' || n_name || '](' || n_name || '.md)', {_NL} ORDER BY 'r' || CAST(n_regionkey AS VARCHAR) || '/' || n_name || '.md') || {_NL} AS content,
CASE WHEN n_regionkey = 0 THEN 'added' ELSE 'unchanged' END AS status FROM nation WHERE n_regionkey <> 3 GROUP BY n_regionkey
UNION ALL SELECT 'r3/README.md', NULL, 'removed'
UNION ALL SELECT 'README.md', '# pages' || {_NL} || {_NL} || string_agg('- [r' || CAST(r AS VARCHAR) || '](r' || CAST(r AS VARCHAR) || '/README.md): ' || CAST(n AS VARCHAR) || ' pages', {_NL} ORDER BY r) || {_NL}, 'updated' FROM (SELECT n_regionkey AS r, count(*) AS n FROM nation WHERE n_regionkey <> 3 GROUP BY 1)""")
def index_pages(spark, d):
    """Index pages after a second run: a folder has come, one has gone, and in the others no title has changed."""
    spec = SourceSpec("pages", "link_index", ("markdown",), "without_front_matter", "https://i.test/llms.txt")
    store, out = SnapshotStore(spark, own_path(spark, "index")), None
    for rows in _states(spark, d, "!"):
        site = _site(_one(rows, spec.url, _f("- [%](/r%/%.md)", "n_name", "n_regionkey", "n_name"), "", "\n"), _pages(rows, _f("https://i.test/r%/%.md", "n_regionkey", "n_name"), _f("text %%", "n_name", "mark")))
        out = run.run_source(spark, spec, store, run.landed(site), index_pages=True)
    told = out.rows.filter(F.endswith("key", F.lit("README.md"))).select("key", "status")
    return told.join(store.read().select("key", "content"), "key", "left")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source || '/index' WHEN doc_id % 3 = 1 THEN 'api-' || lang || '/' || source ELSE lang || '/x/' || source END || '.md' AS path FROM documents")
def rewritten_paths(spark, d):
    """Output paths by a source's rules: pages without a folder get one, a part of the path becomes another, all else stays."""
    spec = SourceSpec("p", "link_index", (), "preamble", "https://p.test", strip="docs", rules=((r"^([^/]+)$", "$1/index"), (r"^reference/([^/]+)/", "api-$1/")))
    k = F.col("doc_id") % 3
    url = F.when(k == 0, _f("https://p.test/docs/%.md", "source")).when(k == 1, _f("https://p.test/docs/reference/%/%", "lang", "source")).otherwise(_f("https://p.test/%/x/%?q=1", "lang", "source"))
    return _t(spark, d, "documents").select("doc_id", run.output_key(spec, url).alias("path"))


_TABLE = f"'| K | %s |' || {_NL} || '| --- | --- |' || {_NL} || '| ' || n_name || ' | '"


@query(f"""SELECT n_name, '## ' || n_name || {_NL} || {_NL} || '> **Warning:** mind *' || CAST(n_nationkey AS VARCHAR) || '* of [l](https://wiki.archlinux.org/title/' || n_name || '#S) | more' || {_NL} || {_NL} || '**term**' || {_NL} || 'meaning ' || CAST(n_regionkey AS VARCHAR) || {_NL} || '1. one' || {_NL} || '  1. two' || {_NL} || '- a' || {_NL} || {_NL}
|| {_TABLE % 'V'} || '[lab](https://wiki.archlinux.org/title/Page#Sec) |' || {_NL} || {_NL} || '`code ' || CAST(n_nationkey AS VARCHAR) || '` [vim](https://archlinux.org/packages/?q=vim) [ls(1)](https://man.archlinux.org/man/ls.1)' || {_NL} || {_NL} || '```' || {_NL} || 'block ' || n_name || {_NL} || '```' || {_NL} || {_NL} || chr(39) || chr(39) || 'n' || chr(39) || chr(39) || {_NL} AS markdown FROM nation""")
def wiki_constructs(spark, d):
    """Notes with marks, links and bars in them, terms, lists in lists, tables, code, packages, what is not to be read as wikitext."""
    text = _f(
        "== % ==\n{{Warning|mind ''%'' of [[%#S|l]] | more}}\n; term : meaning %\n# one\n## two\n* a\n{| class=\"wikitable\"\n! K !! V\n|-\n| % || [[Page#Sec|lab]]\n|}\n{{ic|code %}} {{Pkg|vim}} {{man|1|ls}}\n{{bc|block %}}\n[[Category:X]]\n<nowiki>''n''</nowiki>\n",
        "n_name", "n_nationkey", "n_name", "n_regionkey", "n_name", "n_nationkey", "n_name")
    return _t(spark, d, "nation").select("n_name", V.wikitext_to_markdown(text).alias("markdown"))


@query(f"""SELECT n_name, '# T' || {_NL} || {_NL} || '## ' || n_name || ' & B' || {_NL} || {_NL} || 'one' || {_NL} || 'two *' || CAST(n_nationkey AS VARCHAR) || '* [l](https://h.test/r/' || CAST(n_regionkey AS VARCHAR) || ') ![pic](https://h.test/i.png)' || {_NL} || {_NL} || '1. first' || {_NL} || '  - in ``c`' || CAST(n_nationkey AS VARCHAR) || '``' || {_NL} || '2. second' || {_NL} || {_NL}
|| {_TABLE % ('V' + chr(92) + '|W')} || 'v w |' || {_NL} || {_NL} || '> quoted ' || CAST(n_regionkey AS VARCHAR) || {_NL} || {_NL} || '**t**' || {_NL} || {_NL} || 'd' || {_NL} || {_NL} || '```js' || {_NL} || 'let a = ' || CAST(n_nationkey AS VARCHAR) || ';' || {_NL} || '  b' || {_NL} || '```' || {_NL} || {_NL} || '---' || {_NL} || {_NL} || '~~x~~ **s**' || {_NL} AS markdown FROM nation""")
def html_constructs(spark, d):
    """Line breaks, images, lists in lists, code with marks in it, tables with bars and breaks, quotes, terms, code of a language, rules, struck text."""
    page = _f(
        '<main><h2 id="x">% &amp; B</h2><p>one<br>two <em>%</em> <a href="/r/%">l</a> <img src="/i.png" alt="pic"></p><ol><li>first<ul><li>in <code>c`%</code></li></ul></li><li>second</li></ol>'
        '<table><thead><tr><th>K</th><th>V|W</th></tr></thead><tbody><tr><td>%</td><td>v<br>w</td></tr></tbody></table><blockquote><p>quoted %</p></blockquote><dl><dt>t</dt><dd>d</dd></dl><pre><code class="language-js">let a = %;\n  b</code></pre><hr><p><del>x</del> <strong>s</strong></p></main>',
        "n_name", "n_nationkey", "n_regionkey", "n_nationkey", "n_name", "n_regionkey", "n_nationkey")
    return _t(spark, d, "nation").select("n_name", V.html_to_markdown(page, "plain", F.lit("https://h.test/a/b"), F.lit("T")).alias("markdown"))


_LINK = f"'*Source: [https://p.test/' || CAST(doc_id AS VARCHAR) || '](https://p.test/' || CAST(doc_id AS VARCHAR) || ')*' || {_NL}"


@query(f"""SELECT doc_id, CASE k WHEN 0 THEN '' WHEN 1 THEN '# T' || source || {_NL} || {_NL} ELSE '# In ' || lang || {_NL} || {_NL} END || link || {_NL} || body || {_NL} AS titled,
CASE k WHEN 2 THEN '' ELSE '# T' || source || {_NL} || {_NL} END || link || {_NL} || body || {_NL} AS sourced, CASE k WHEN 1 THEN '# T' || source || {_NL} || {_NL} ELSE '' END || link || body || {_NL} AS bannered,
'# ' || CASE k WHEN 2 THEN '' ELSE 'T' || source END || {_NL} || {_NL} || link || CASE WHEN doc_id % 2 = 0 THEN {_NL} || 'about ' || lang || {_NL} ELSE '' END || {_NL} || '---' || {_NL} || 'text' || {_NL} AS headed,
'# ' || source || {_NL} || link || {_NL} || {_NL} || 'a' || {_NL} || 'b ' || lang || {_NL} AS concatenated,
CASE WHEN k = 0 THEN '# T ' || source || {_NL} || {_NL} || 'in ' || lang || {_NL} || {_NL} || 'after' END AS plain
FROM (SELECT *, doc_id % 3 AS k, {_LINK} AS link, CASE doc_id % 3 WHEN 0 THEN '# T' || source || ' more' WHEN 1 THEN 'text ' || lang ELSE 'text ' || lang || {_NL} || '# In ' || lang END AS body FROM documents)""")
def page_formats(spark, d):
    """How pages of several hosts are headed: by title, by source, with a summary, out of a corpus, without components; bodies begin with an empty line."""
    k, t = F.col("doc_id") % 3, F.concat(F.lit("T"), F.col("source"))
    title = F.when(k == 2, F.lit("")).otherwise(t)
    url = _f("https://p.test/%", "doc_id")
    body = F.when(k == 0, F.concat(F.lit("\n# "), t, F.lit(" more\n\n"))).when(k == 1, _f("\ntext %\n", "lang")).otherwise(_f("\ntext %\n# In %\n", "lang", "lang"))
    banner = F.lit("> ## Documentation Index\n> Fetch it at: x\n> Use it.\n\n")
    mdx = F.when(k == 0, _f("> index\n\n# T %\n\n\n<Note type='x'>\nin %\n</Note>\n\n\n<Card title='c'/>after\n", "source", "lang")).otherwise(F.lit("no heading"))
    named = F.when(k == 2, F.lit("")).otherwise(title)
    return _t(spark, d, "documents").select(
        "doc_id", T.titled_page(body, title, url).alias("titled"), T.sourced_page(body, title, url).alias("sourced"), T.sourced_page(F.when(k == 1, F.concat(banner, body)).otherwise(body), named, url, banner=True).alias("bannered"),
        T.headed_page(F.concat(banner, F.lit("text\n\n")), title, url, F.when(F.col("doc_id") % 2 == 0, _f("about %", "lang"))).alias("headed"),
        T.concatenated_page(_f("\na\n <Scopes />\nb %\n\n", "lang"), "source", url).alias("concatenated"), T.without_components(mdx).alias("plain"))
