"""Discovery and fetching over literals; no network."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessaline.sources import discover as D
from tessaline.sources import transport as N
from tessaline.sources import registry as S


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_sitemaps(spark):
    xml = '<urlset xmlns="x"><url><loc>https://h/a</loc><lastmod>1</lastmod></url><url><loc> https://h/b?x=1&amp;y </loc></url><url><loc>https://z/c</loc></url></urlset>'
    shards = spark.createDataFrame([(1, xml), (2, "<urlset><url><loc>https://h/a</loc><lastmod>2</lastmod></url></urlset>"), (3, None)], "shard int, xml string")
    assert [r["url"] for r in D.sitemap_urls(shards.filter("shard = 1")).orderBy("ord").collect()] == ["https://h/a", "https://h/b?x=1&y", "https://z/c"]
    assert D.sitemap_by_path(shards.filter("shard = 2")).first()["url"] == "https://h/a"
    entries, complete = D.sharded_sitemap(shards, "h")
    assert rows(entries.fillna("", ["lastmod"]), "path", "lastmod") == [("a", "2"), ("b", "")]
    assert tuple(complete.first()) == (False, 3, 1)


def test_indexes_and_corpora(spark):
    text = "# T\n\n## One\n- [A](https://h/a.md): first\n- [B](https://h/b.md)\n## Two\n- [A2](https://h/a.md): later\ntext"
    got = D.link_index(spark.createDataFrame([("s", text)], "source string, text string"))
    assert rows(got, "url", "title", "section", "summary") == [("https://h/a.md", "A", "One", "first"), ("https://h/b.md", "B", "One", "")]
    whole = "# A\nSource: u1\nbody\n# inside\n# B\nSource: u2\nx\n# A3\nSource: u1\nlast\n"
    assert rows(D.concatenated_pages(spark.createDataFrame([("s", whole)], "source string, text string")), "url", "title", "body") == [("u1", "A3", "last\n"), ("u2", "B", "x\n")]


def test_trees_wikis_directories(spark):
    tree = json.dumps({"truncated": True, "tree": [{"type": "blob", "path": "docs/a.md", "sha": "1"}, {"type": "tree", "path": "docs/x.md"}, {"type": "blob", "path": "README.md", "sha": "2"}, {"type": "blob", "path": "src/b.md", "sha": "3"}]})
    assert rows(D.tree_files(spark.createDataFrame([("s", tree)], "source string, json string"), ["docs/"], [".md"], ["README.md"]), "path", "sha", "truncated") == [("README.md", "2", True), ("docs/a.md", "1", True)]
    replies = [("1", json.dumps({"query": {"pages": [{"title": "A", "revisions": [{"revid": 5, "content": "text"}], "categories": [{"title": "Category:X"}]}, {"title": "M", "missing": True}]}, "continue": {"c": "1"}})), ("1", json.dumps({"query": {"pages": [{"title": "A", "categories": [{"title": "Category:Y"}, {"title": "Category:X"}]}]}})), ("2", "broken")]
    pages, batches = D.wiki_pages(spark.createDataFrame(replies, "batch string, json string"))
    assert rows(pages, "title", "revision", "content", "categories") == [("A", 5, "text", ["X", "Y"])] and rows(batches, "batch", "failed") == [("1", False), ("2", True)]
    items = json.dumps({"items": [{"id": "a", "v": "1"}, {"id": "a", "v": "2"}]})
    assert rows(D.json_directory(spark.createDataFrame([(items,)], "json string"), "id:string,v:string"), "id", "v") == [("a", "2")]
    assert rows(D.paged(spark.createDataFrame([("s", 3), ("t", 1)], "source string, total_pages int")), "source", "page") == [("s", 2), ("s", 3)]
    assert D.valid_documents(spark.createDataFrame([('{"kind":"k"}',), ("{",)], "json string"), "k").count() == 1


def test_navigation(spark):
    html = '<summary class="group">G</summary><a href="/docs/a/">A</a><a href="/docs/a/">again</a><h3 class="large">H</h3><a href="https://h/docs/b">B</a><a href="/x">X</a>'
    assert rows(D.sidebar(spark.createDataFrame([("s", html)], "source string, html string"), "/docs"), "slug", "grp", "title") == [("a", "G", "A"), ("b", "H", "B")]
    urls = spark.createDataFrame([(f"https://h/docs/{p}",) for p in ("fr/", "fr/a", "cli", "cli/x", "en")], "url string")
    assert rows(D.english_paths(urls, "/docs"), "url") == [("https://h/docs/cli",), ("https://h/docs/cli/x",), ("https://h/docs/en",)]
    nav = "site: x\nnav:\n  - Home: index.md\n  - Guide:\n    - One: g/one.md\n    - g/two.md\n  - End: end.md\nother: y"
    assert [(r["depth"], r["parents"], r["title"], r["page"]) for r in D.navigation(spark.createDataFrame([("s", nav)], "source string, text string")).orderBy("ord").collect()] == [(0, [], "Home", "index.md"), (0, [], "Guide", None), (1, ["Guide"], "One", "g/one.md"), (1, ["Guide"], "", "g/two.md"), (0, [], "End", "end.md")]
    assert rows(D.sphinx_names(spark.createDataFrame([("s", 'Search.setIndex({"docnames": ["a", "b/c"], "x": 1})')], "source string, script string")), "name") == [("a",), ("b/c",)]
    assert rows(D.toctree_edges(spark.createDataFrame([("i", ".. toctree::\n\n   A <a>\n   b\n")], "name string, text string")), "src", "title", "dst") == [("i", "", "b"), ("i", "A", "a")]


def test_scripts_and_embedded_objects(spark):
    main = """x={path:"/a",component:p("@layout","c1")},{path:"/b",component:p("c2")};r={"/a-c1":{"args":"x","content":"facade"},"/b-c2":{"content":"w-2"}};
        l={facade:[()=>Promise.all([n.e(5),n.e(12)]).then(n.bind(n,77)),"@site/a.mdx",77],"w-2":[()=>n.e(13).then(n.bind(n,78)),"@site/b.mdx",78],other:[1,2]}"""
    runtime = """q.u=e=>"js/"+({12:"deadbeef",14:"only-name"}[e]||e)+"."+({12:"aa",13:"bb"}[e]||e)+".js",q.f={}"""
    scripts, runtimes = (spark.createDataFrame([("s", x)], "source string, script string") for x in (main, runtime))
    assert rows(D.script_routes(scripts)["routes"], "route", "chunk") == [("/a", "c1"), ("/b", "c2")]
    assert rows(D.chunk_files(runtimes), "chunk", "file") == [("12", "js/deadbeef.aa.js"), ("13", "js/13.bb.js"), ("14", "js/only-name.14.js")]
    assert rows(D.route_contents(scripts, runtimes), "route", "module", "made_from", "file") == [("/a", "77", "@site/a.mdx", "js/deadbeef.aa.js"), ("/b", "78", "@site/b.mdx", "js/13.bb.js")]
    assert D.chunk_files(scripts).count() == 0 and rows(D.script_urls(spark.createDataFrame([("s", '<script src="/m.js"></script><script src="/x.css">')], "source string, html string")), "url") == [("/m.js",)]
    html = '<div data-page="{&quot;p&quot;:{&quot;slug&quot;:&quot;api&quot;,&quot;v&quot;:1}}"></div>'
    assert json.loads(D.embedded_object(spark.createDataFrame([("u", html)], "url string, html string"), "slug", "api").first()["json"]) == {"slug": "api", "v": 1}
    data = json.dumps({"pageProps": {"source": {"frontmatter": {"title": "T"}, "compiledSource": "s"}}})
    assert tuple(D.page_data(spark.createDataFrame([("u", data)], "url string, json string")).first()) == ("u", "T", None, "s")


def test_landing_and_chains(spark):
    landed = spark.createDataFrame([("a", 1), ("b", 30)], "k string, h int").withColumn("fetched_at", F.current_timestamp() - F.make_interval(hours=F.col("h")))
    assert rows(D.fresh(landed), "k") == [("a",)]
    chain = spark.createDataFrame([("s", 1, "<html>"), ("s", 2, '{"paths": {}}'), ("s", 3, "[]")], "source string, ord int, json string")
    assert rows(D.first_valid(chain), "ord") == [(2,)]
    got = D.batched(spark.range(300).select(F.col("id").cast("string").alias("title")), 5)
    assert got.groupBy("batch").count().agg(F.max("count")).first()[0] == 5 and got.count() == 300


def test_policies():
    naps: list[float] = []
    answers = iter([N.Reply(503), N.Reply(429, None, {"retry-after": "7"}), N.Reply(200, b"ok")])
    reply, tries = N.fetch("u", lambda u, h: next(answers), N.POLICIES["budget"], sleep=naps.append, clock=lambda: sum(naps))
    assert (reply.status, tries, naps) == (200, 3, [1.5, 7.0])
    naps.clear()
    reply, tries = N.fetch("u", lambda u, h: N.Reply(429, None, {"retry-after": "25"}), N.POLICIES["budget"], sleep=naps.append, clock=lambda: sum(naps))
    assert reply.status == 429 and naps == []
    assert N.fetch("u", lambda u, h: N.Reply(404), N.POLICIES["schedule"], sleep=naps.append)[1] == 1
    hops = {"https://h/a": N.Reply(302, None, {"location": "/b"}), "https://h/b": N.Reply(200, b"x"), "https://h/c": N.Reply(301, None, {"location": "https://z/"})}
    assert N.fetch("https://h/a", lambda u, h: hops[u], N.POLICIES["schedule"])[0].body == b"x" and N.fetch("https://h/c", lambda u, h: hops[u], N.POLICIES["schedule"])[0].status == 404
    seen: list = []
    N.fetch("u", lambda u, h: seen.append(h) or N.Reply(304), etag='"e"')
    assert seen == [{"If-None-Match": '"e"'}]
    assert N.changed_by_head("u", "e", lambda u, h: N.Reply(200, None, {"etag": "f"})) and not N.changed_by_head("u", "e", lambda u, h: N.Reply(200, None, {"etag": "e"}))


def test_cookies(tmp_path):
    (tmp_path / "c").write_text("# note\nCookie: a=1\n")
    assert N.cookie_header(path=str(tmp_path / "c")) == {"Cookie": "a=1"} and N.cookie_header() == {}


def test_fetch_as_rows(spark):
    def transport(url, headers):
        if url.endswith("x"):
            raise OSError("down")
        return N.Reply(200, url.encode(), {"etag": "e"})

    manifest = spark.createDataFrame([("u1",), ("ux",)], "url string")
    assert rows(N.fetch_all(manifest, transport).withColumn("b", F.col("body").cast("string")), "url", "status", "b") == [("u1", 200, "u1"), ("ux", 0, None)]


def test_data_source(spark, monkeypatch):
    reader = N._WebReader({"urls": "a\nb\nc", "parts": "2"})
    reader.transport = lambda u, h: N.Reply(200, u.encode())
    assert sorted(r[0] for p in reader.partitions() for r in reader.read(p)) == ["a", "b", "c"]
    spark.dataSource.register(N.WebSource)
    assert spark.read.format("web").option("urls", "").load().columns == ["url", "status", "body", "etag", "attempts", "error"]


def test_selection():
    assert len(S.SOURCES) == 38 and S.select_sources(["circle", "2-3", "circleci"]) == ["circleci", "anthropic", "arch"]
    assert "sentinelone" not in S.select_sources(["all"])
    for bad in ("o", "zzz"):
        with pytest.raises(ValueError):
            S.select_sources([bad])
