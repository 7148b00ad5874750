"""Runs that follow replies, gates by scope, deltas, totals by range, slices: small cases, failures, ties."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessaline.functions import convert as V
from tessaline.functions import html_md as H
from tessaline.operators import documents as P
from tessaline.operators import graph as G
from tessaline.operators import relational as R
from tessaline.operators import state as S
from tessaline.plans import cli, followed, run
from tessaline.plans.store import Pile, SnapshotStore
from tessaline.sources import discover as D
from tessaline.sources import requests as Q
from tessaline.sources import transport as N
from tessaline.sources.registry import SourceSpec

from .conftest import compare, duck

NAMES = [n for n, f in entry.queries().items() if f.__module__ == followed.__name__]
PAGE = "url string, body string, etag string, status int"


@pytest.mark.parametrize("name", NAMES)
def test_followed_queries(spark, name, small):
    compare(entry.queries()[name](spark, small).toPandas(), duck(small).execute(entry.oracle_sql()[name]).df())


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def site(spark, pages):
    """url to body, or to (status, body, etag)."""
    full = {u: v if isinstance(v, tuple) else (200, v, None) for u, v in pages.items()}
    return spark.createDataFrame([(u, b, e, s) for u, (s, b, e) in full.items()], PAGE)


# ---------------------------------------------------------------- deltas

def test_deltas_are_merged_on_read_and_folded(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s", most=4)
    frame = lambda *r: spark.createDataFrame(list(r), "key string, v int")
    ballast = F.concat_ws("", *[F.sha2(F.concat("key", F.lit(str(k))), 256) for k in range(8)])
    first = store.append(frame(*[(f"k{n:03}", n) for n in range(500)]).withColumn("text", ballast), note="one")
    assert store.note() == "one" and store.read().count() == 500
    store.append(frame(("k001", -1), ("new", 7)), frame(("k002", 0)))
    old = store.read()
    store.append(frame(("k002", 5)), frame(("new", 0), ("never", 0)))
    now = {r["key"]: r["v"] for r in store.read().collect()}
    assert len(now) == 500 and now["k001"] == -1 and now["k002"] == 5 and "new" not in now
    assert {r["key"] for r in old.collect()} >= {"new"} and old.filter("key = 'k002'").isEmpty()
    held = [v for v in store.versions()]
    assert len(held) == 3 and max(store.size(v) for v in held[1:]) * 2 < store.size(first)
    # Nothing changed: no version; a note alone moves the pointer. Another column is null before it came.
    assert store.append(frame(), frame()) == held[-1] and len(store.versions()) == 3 and store.append(frame(), note="two") == held[-1] and store.note() == "two"
    store.append(frame(("k003", 3)).withColumn("w", F.lit("x")))
    assert rows(store.read().filter("key IN ('k003', 'k004')"), "key", "v", "w") == [("k003", 3, "x"), ("k004", 4, None)]
    with pytest.raises(ValueError, match="deltas here are by"):
        store.append(spark.createDataFrame([("k", 1)], "other string, v int"), key="other")
    # The fourth delta folds them; what is not held any more can go.
    last = store.append(frame(("k004", 44)))
    assert store.read().count() == 500 and store.read().filter("key = 'k004'").first()["v"] == 44 and store.note() is None
    store.prune(1)
    assert store.versions() == [last]
    assert "missing" in store.read("key string, missing date").columns


def test_large_deltas_fold_at_once(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    store.append(spark.createDataFrame([("a", 1)], "key string, v int"))
    name = store.append(spark.createDataFrame([(str(n), n) for n in range(300)], "key string, v int"))
    assert store._pointer()["versions"] == [name] and store.read().count() == 301


def test_piles_of_no_rows(spark):
    schema = spark.createDataFrame([], "a int, b string").schema
    pile = Pile(spark, schema)
    assert pile.read().count() == 0
    pile.add(spark.createDataFrame([("x", 1)], "b string, a int"))
    pile.add(spark.createDataFrame([("y", 2)], "b string, a int"))
    assert rows(pile.read(), "a", "b") == [(1, "x"), (2, "y")]


# ---------------------------------------------------------------- gates and tokens

def test_gates_are_a_relation(spark):
    planned = spark.createDataFrame([("a",), ("a",), ("b",), ("u",), (None,)], "scope string")
    declared = spark.createDataFrame([("a", True, 2), ("a", True, 1), ("b", True, 5), ("c", True, 1), ("d", False, 0), ("gone", True, 0), ("n", None, 0)], "scope string, complete boolean, least_rows int")
    got = {r["scope"]: (r["rows"], r["open"]) for r in S.scope_gates(planned, declared).collect()}
    assert got == {"a": (2, True), "b": (1, False), "c": (0, False), "d": (0, False), "gone": (0, True), "n": (0, False), "u": (1, False), None: (1, False)}
    assert not any(r["open"] for r in S.scope_gates(planned, declared, filtered=True).collect())
    assert {r["scope"]: r["open"] for r in S.scope_gates(planned, declared.drop("least_rows")).collect()}["gone"] is False
    outcomes = spark.createDataFrame([("a", "added"), ("a", "preserved"), ("b", "unchanged"), ("c", "failed")], "scope string, status string")
    tokens = spark.createDataFrame([(s, "t") for s in "abcd"], "scope string, token string")
    assert rows(S.settled_tokens(outcomes, tokens), "scope") == [("b",), ("d",)]


# ---------------------------------------------------------------- totals by range

@pytest.mark.parametrize("parts", [1, 7])
def test_totals_of_groups_of_any_size(spark, parts):
    """A hot group over many partitions, small groups, nulls in keys and order, repeated rows."""
    data = [("hot", k % 90, 1) for k in range(400)] + [(None, k, 2) for k in range(5)] + [("x", None, 3), ("x", 1, 4), ("y", 1, 5)] * 2
    df = spark.createDataFrame(data, "g string, o int, v int").repartition(parts)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = [tuple(r) for r in R.running_total(df, ["g"], [F.col("o").asc_nulls_first()], F.col("v"), "t").collect()]
        plain = sorted(r[1] for r in (tuple(x) for x in R.numbered(df.select("o"), [], [F.col("o").asc_nulls_first()], "n").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert plain == list(range(1, len(data) + 1))
    for g in {d[0] for d in data}:
        mine = sorted((r for r in got if r[0] == g), key=lambda r: r[3])
        order = [(r[1] is not None, r[1] or 0) for r in mine]
        assert order == sorted(order) and len(mine) == sum(d[0] == g for d in data)
        total = 0
        for r in mine:
            total += r[2]
            assert r[3] == total
    assert [r["batch"] for r in R.batches(df.filter("g = 'hot'"), "g", "o", 150).orderBy("batch").collect()] == [0] * 150 + [1] * 150 + [2] * 100
    assert R.numbered(df.limit(0), ["g"], ["o"]).count() == 0


def test_prefixes_of_repeated_rows(spark):
    paths = spark.createDataFrame([("a/b/c", 1), ("a/b/c", 1), ("a/bc", 2), ("z", 3), (None, 4), ("", 5)], "path string, n int")
    prefixes = spark.createDataFrame([("a", "x"), ("a/b", "y"), ("a/b", "w"), ("a/b/c/d", "v")], "prefix string, p string")
    assert rows(R.prefix_join(paths, prefixes), "path", "n", "p") == [("a/b/c", 1, "w"), ("a/b/c", 1, "w"), ("a/bc", 2, "x")]


# ---------------------------------------------------------------- reading order

def brute_order(edges, roots):
    seen, out = set(), []

    def walk(n, parent, depth):
        if n in seen:
            return
        seen.add(n)
        out.append((n, parent, depth))
        for _, dst in sorted((o, t) for s, o, t in edges if s == n):
            walk(dst, n, depth + 1)

    for _, r in sorted((o, n) for n, o in roots):
        walk(r, None, 0)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_reading_order_is_depth_first(spark, seed):
    """Random graphs with cycles, several roots, entries that stand twice."""
    import random

    rnd = random.Random(seed)
    names = [f"n{k}" for k in range(9)]
    edges = [(s, o, rnd.choice(names)) for s in names for o in range(rnd.randint(0, 3))]
    roots = [("n0", 0), ("n5", 1)]
    order = G.reading_order(spark.createDataFrame(edges, "src string, ord int, dst string"), spark.createDataFrame(roots, "node string, ord int"))
    got = [(r["node"], r["parent"], r["depth"]) for r in order.orderBy("number").collect()]
    assert got == brute_order(edges, roots) and [r["number"] for r in order.orderBy("number").collect()] == list(range(1, len(got) + 1))


def test_reading_lines(spark):
    edges = spark.createDataFrame([("i", 0, "a", "Start", ""), ("i", 1, "b", "Start", "Bee"), ("i", 2, "https://x.test", "More", "X"), ("a", 0, "c", "", ""), ("i", 3, None, "", "")], "src string, ord int, dst string, caption string, title string")
    order = G.reading_order(edges, spark.createDataFrame([("i", 0)], "node string, ord int")).filter("depth > 0")
    titles = spark.createDataFrame([("a", "Ay"), ("c", "Sea")], "node string, name string")
    lines = [r["line"] for r in G.reading_lines(order, titles).orderBy("number").collect()]
    assert lines == ["## Start\n\n- [Ay](a.md)", "  - [Sea](c.md)", "- [Bee](b.md)", "## More\n\n- [X](https://x.test)"]


# ---------------------------------------------------------------- slices

MANUAL = """<div class="preface"><h1 id="pre">Before</h1><p>see <a href="#c2">two</a></p></div>
<div class="part" id="one"><h1>One</h1><p>intro</p><div class="chapter"><h2 id="c1">C</h2><p>x<a name="deep"></a></p></div></div>
<div class="chapter"><h2 id="c2">C</h2><p><a href="#deep">d</a> <a href="#c2">me</a> <a href="https://x.test/#c1">out</a></p><div class="section"><h3 id="s">S</h3><p>inside</p></div></div>
<div class="chapter"><h1 id="alone">Alone</h1></div>"""


def test_slices_of_a_page(spark):
    made = H.slices(MANUAL, [["preface", "part"], ["chapter"]])
    assert [(d["kind"], d["anchor"], d["title"], d["parent"], d["trail"]) for d in made] == [
        ("preface", "pre", "Before", None, ["pre"]), ("part", "one", "One", None, ["one"]), ("chapter", "c1", "C", 1, ["one", "c1"]), ("chapter", "c2", "C", 1, ["one", "c2"]), ("chapter", "alone", "Alone", None, ["alone"])]
    assert made[2]["anchors"] == ["c1", "deep"] and "intro" in made[1]["markdown"] and "x" not in made[1]["markdown"].replace("intro", "") and "inside" in made[3]["markdown"]
    pages = spark.createDataFrame([("m", MANUAL), ("n", '<div class="part"><h1 id="deep">N</h1></div><div class="part"><h1 id="deep">N</h1></div>'), ("o", None), ("p", "<p>no documents</p>")], "source string, html string")
    docs = P.sliced(pages, [["preface", "part"], ["chapter"]])
    assert rows(docs, "source", "path") == [("m", "alone.md"), ("m", "one.md"), ("m", "one/c1.md"), ("m", "one/c2.md"), ("m", "pre.md"), ("n", "deep-2.md"), ("n", "deep.md")]
    text = {(r["source"], r["path"]): r["markdown"] for r in P.relinked(docs).collect()}
    assert "[two](one/c2.md#c2)" in text["m", "pre.md"] and "[d](c1.md#deep) [me](#c2) [out](https://x.test/#c1)" in text["m", "one/c2.md"]


def test_kinds_of_bodies(spark):
    from base64 import b64encode
    from zlib import compress

    packed = b64encode(compress(json.dumps({"openapi": "3.0.0", "paths": {}}).encode())).decode()
    bodies = {None: "empty", " \n": "empty", '{"openapi":"3.0.0","paths":{}}': "openapi", "swagger: '2.0'\npaths: {}": "swagger", '{"a":1}': "json", "{broken": "markdown", "<!DOCTYPE html><p>": "html", f'"use strict";x={{api:"{packed}"}}': "packed",
              '"use strict";function _createMdxContent(p){}': "compiled", "var x = 1": "script", "import A from 'b'\n\n# T": "mdx", "text <Note>x</Note>": "mdx", "# T\n\nplain": "markdown", '{"apiList":[],"content":{}}': "vendor"}
    frame = spark.createDataFrame([(b, k) for b, k in bodies.items()], "body string, kind string")
    got = frame.select("body", "kind", V.body_kind("body").alias("told"), V.packed_description("body").alias("d")).collect()
    assert [(r["body"], r["told"]) for r in got] == [(r["body"], r["kind"]) for r in got] and [r["d"] for r in got if r["kind"] == "packed"] == ['{"openapi": "3.0.0", "paths": {}}']


# ---------------------------------------------------------------- dependent requests

def test_pages_that_a_reply_counts(spark):
    web = site(spark, {"a?": '{"n":3}', "a?2": "two", "a?3": (500, None, None), "b?": '{"n":1}', "c?": (404, None, None)})
    first = spark.createDataFrame([("a", "a?"), ("b", "b?"), ("c", "c?")], "k string, url string")
    got = Q.all_pages(first, run.landed(web), F.get_json_object("body", "$.n"), lambda u, p: F.concat(u, p.cast("string")))
    assert rows(got, "k", "page", "status") == [("a", 1, 200), ("a", 2, 200), ("a", 3, 500), ("b", 1, 200), ("c", 1, 404)]
    assert rows(Q.complete_by(got, "k"), "k", "complete") == [("a", False), ("b", True), ("c", False)]


def test_equal_requests_are_sent_once(spark):
    sent = spark.sparkContext.accumulator(0)
    web = run.landed(site(spark, {"u": (200, "x", "e")}))

    def get(asked):
        sent.add(asked.count())
        return web(asked)

    got = Q.ask(spark.createDataFrame([("u", 1), ("u", 2), (None, 3), ("v", 4)], "url string, n int"), get)
    assert sent.value == 2 and rows(got, "n", "status", "body") == [(1, 200, "x"), (2, 200, "x"), (3, 0, None), (4, 404, None)]
    steps = Q.follow(spark.createDataFrame([("u",)], "url string"), web, lambda r: r.select(F.lit("v").alias("url")), lambda r: r.select(F.lit("w").alias("url")))
    assert [s.count() for s in steps] == [1, 1, 0]


def test_continuations_replace_earlier_parameters(spark):
    replies = spark.createDataFrame([(1, "https://w/api.php?a=1&gapfrom=A", '{"continue":{"gapfrom":"B c","continue":"x"}}'), (2, "https://w/api.php?a=1", '{"batchcomplete":true}'), (3, "https://w/api.php?a=1", "<html>")], "batch int, url string, body string")
    assert rows(Q.continued(replies), "batch", "url") == [(1, "https://w/api.php?a=1&gapfrom=B+c")]


def test_trees_of_sitemaps(spark):
    index = lambda *u: "<s:sitemapindex xmlns:s='x'>" + "".join(f"<s:sitemap><s:loc> {x} </s:loc></s:sitemap>" for x in u) + "</s:sitemapindex>"
    urls = lambda *u: "<urlset>" + "".join(f"<url><loc>{x}</loc><lastmod>{m}</lastmod></url>" for x, m in u) + "</urlset>"
    web = site(spark, {
        "https://h.t/s.xml": index("https://h.t/a.xml", "https://h.t/b.xml", "https://h.t/a.xml", "https://other.t/c.xml", "https://h.t/s.xml", "https://h.t/e.xml", "https://h.t/l.xml"), "https://h.t/a.xml": index("https://h.t/d.xml"),
        "https://h.t/b.xml": urls(("https://h.t/x?a=1&amp;b=2", "1"), ("https://h.t/y", "1"), ("https://z.t/q", "1")), "https://h.t/d.xml": urls(("https://h.t/y", "2")), "https://h.t/e.xml": "<html>sorry</html>", "https://h.t/l.xml": (503, None, None)})
    start = spark.createDataFrame([("https://h.t/s.xml",)], "url string").join(web, "url").select("url", "status", F.col("body").alias("text"))
    entries, shards = D.sitemap_tree(start, run.landed(web), "h.t")
    assert rows(entries, "path", "lastmod", "scope") == [("x", "1", "https://h.t/b.xml"), ("y", "2", "https://h.t/d.xml")]
    assert dict(rows(shards, "scope", "complete")) == {"https://h.t/s.xml": True, "https://h.t/a.xml": True, "https://h.t/b.xml": True, "https://h.t/d.xml": True, "https://h.t/e.xml": False, "https://h.t/l.xml": False}
    with pytest.raises(ValueError, match="levels"):
        D.sitemap_tree(start, run.landed(web), "h.t", most=1)


# ---------------------------------------------------------------- runs

def counts(spark, spec, store, pages, **more):
    return run.run_source(spark, spec, store, run.landed(site(spark, pages)), **more).counts


def test_parts_in_order_and_their_rules(spark, tmp_path):
    """Of a key that two parts give the first counts; classes, prefixes and suffixes make output paths; other hosts and paths stay out."""
    spec = SourceSpec("o", "link_index+sitemap_by_path", (), "preamble", "https://o.t/llms.txt", also=("https://o.t/map.xml",), within="/docs/", strip="docs", suffix=".md", rules=((r"^api/(.*)$", "reference/$1"), (r"^([^/]+)$", "general/$1")))
    pages = {spec.url: "- [First](/docs/a.md)\n- [No](/blog/b)\n- [Api](/docs/api/c)\n", spec.also[0]: "<urlset><url><loc>https://o.t/docs/a</loc></url><url><loc>https://o.t/docs/d</loc></url></urlset>", "https://o.t/docs/a.md": "text a", "https://o.t/docs/api/c.md": "text c", "https://o.t/docs/d.md": "text d"}
    store = SnapshotStore(spark, f"file://{tmp_path}/o")
    assert counts(spark, spec, store, pages) == {"added": 3}
    assert rows(store.read(), "key", "scope") == [("general/a.md", "0|"), ("general/d.md", "1|"), ("reference/c.md", "0|")]
    assert {r["title"] for r in store.read().collect()} >= {"First", "Api"}
    # One part's index is an error page: its rows stay; the other part loses what it names no more.
    assert counts(spark, spec, store, {**pages, spec.also[0]: "<html>oops</html>", spec.url: "- [First](/docs/a.md)\n"}) == {"unchanged": 1, "removed": 1}
    assert rows(store.read(), "key") == [("general/a.md",), ("general/d.md",)]


def test_descriptions_by_etag(spark, tmp_path):
    spec = SourceSpec("d", "fixed", (), "endpoint_documents", "https://d.t/a.json", failure="scope", also=("https://d.t/b.json",))
    doc = lambda *names: json.dumps({"openapi": "3.0.0", "paths": {f"/{n}": {"get": {"tags": ["T"], "summary": n}} for n in names}})
    store = SnapshotStore(spark, f"file://{tmp_path}/d")
    first = {spec.url: (200, doc("a", "b"), '"1"'), spec.also[0]: (200, doc("c"), None)}
    assert counts(spark, spec, store, first, raw=f"file://{tmp_path}/raw") == {"added": 3} and len(list((tmp_path / "raw/d").glob("*.json"))) == 2
    # The same validator: 304, whatever the body says by now; the other description is gone from the web, and keeps its documents.
    assert counts(spark, spec, store, {spec.url: (200, doc("z"), '"1"'), spec.also[0]: (404, None, None)}) == {"unchanged": 2}
    assert counts(spark, spec, store, {spec.url: (200, doc("a"), '"2"'), spec.also[0]: (200, "<html>", None)}) == {"unchanged": 1, "removed": 1}
    assert rows(store.read(), "key") == [("t/get-a.md",), ("t/get-c.md",)]
    with pytest.raises(run.SourceFailed):
        counts(spark, SourceSpec(**{**spec.__dict__, "failure": "abort"}), store, {spec.url: (500, None, None)})


def test_registry_of_one_provider(spark, tmp_path):
    spec = SourceSpec("r", "registry_documents", (), "registry_document", "https://r.t/v2/providers?page[size]=100")
    pages = {spec.url: '{"data":[]}', "https://r.t/v1/providers/o/p": '{"version":"1"}', "https://r.t/v1/providers/o/p/1": '{"docs":[{"id":"7","category":"c","slug":"s","title":"S"},{"id":"8","slug":"t"}]}'}
    pages |= {f"https://r.t/v2/provider-docs/{k}": json.dumps({"data": {"attributes": {"content": f"---\nx: 1\n---\n# D{k}\n"}}}) for k in (7, 8)}
    store = SnapshotStore(spark, f"file://{tmp_path}/r")
    assert counts(spark, spec, store, pages, providers=("o/p",)) == {"added": 2}
    assert rows(store.read(), "key", "content") == [("o/p/c/s.md", "# D7\n"), ("o/p/other/t.md", "# D8\n")]
    # Current: carried over without a request for any document; forced: asked for again.
    bare = {u: b for u, b in pages.items() if "provider-docs" not in u}
    assert counts(spark, spec, store, bare, providers=("o/p",)) == {"unchanged": 2}
    assert counts(spark, spec, store, {**pages, "https://r.t/v1/providers/o/p": (500, None, None)}, providers=("o/p",)) == {} and store.read().count() == 2


def test_manifests_kept_and_runs_in_parts(spark, tmp_path):
    spec = SourceSpec("m", "sitemap_tree", (), "html_to_markdown", "https://m.t/s.xml", token="lastmod")
    urls = lambda *n: "<urlset>" + "".join(f"<url><loc>https://m.t/{x}</loc><lastmod>1</lastmod></url>" for x in n) + "</urlset>"
    body = {f"https://m.t/{n}": f"<main><p>{n}</p></main>" for n in "abcd"}
    store, where = SnapshotStore(spark, f"file://{tmp_path}/m"), f"file://{tmp_path}/manifests"
    assert counts(spark, spec, store, {spec.url: urls(*"abc"), **body}, manifests=where, commits=2) == {"unchanged": 3} and store.read().count() == 3
    # The kept manifest is used, so the new address is not seen until it is too old.
    assert counts(spark, spec, store, {spec.url: urls(*"bcd"), **body}, manifests=where) == {"unchanged": 3}
    assert counts(spark, spec, store, {spec.url: urls(*"bcd"), **body}, manifests=where, hours=0) == {"unchanged": 2, "added": 1, "removed": 1}
    broken = {spec.url: "<sitemapindex><sitemap><loc>https://m.t/x.xml</loc></sitemap></sitemapindex>"}
    assert counts(spark, spec, store, {**broken, **body}, manifests=f"{where}-2") == {} and store.read().count() == 3


def test_access_is_verified_before_anything_is_fetched(spark, tmp_path):
    asked = []
    send = lambda url, headers: asked.append(url) or N.Reply(302, None, {"location": "/login"})
    get = lambda a: pytest.fail("fetched")
    lines = []
    assert cli.main(["sentinelone", "--base-url", "https://s.t", "--cookie", "k=v", "--state", f"file://{tmp_path}"], spark, get, lines.append, send) == 1
    assert asked == ["https://s.t"] and "AccessDenied" in lines[0]


def test_options_of_sources(spark, capsys):
    c = cli.parse(["terraform", "--", "--provider", "a/b", "--raw", "/r", "--manifest-cache", "/m", "--manifest-hours", "2", "--commits", "4", "--include", "^x", "--exclude", "y$"])
    assert c.providers == ("a/b",) and (c.raw, c.manifests, c.hours, c.commits) == ("/r", "/m", 2.0, 4)
    keys = spark.createDataFrame([("xa",), ("xy",), ("b",)], "key string")
    assert rows(keys.filter(c.options.scope), "key") == [("xa",)]
    for bad in (["terraform", "--provider", "a"], ["ollama", "--provider", "a/b"]):
        assert cli.main(bad, spark) == 2
    capsys.readouterr()


def test_index_pages_give_way_to_pages(spark, tmp_path):
    """A folder whose README.md is a page of the source gets no index page; a run that removes pages takes them out of the index."""
    spec = SourceSpec("i", "link_index", (), "without_front_matter", "https://i.t/llms.txt")
    pages = {spec.url: "- [Own](/a/README.md)\n- [One](/a/one.md)\n- [Two](/b/two.md)\n- [Top](/top.md)\n", "https://i.t/a/README.md": "own", "https://i.t/a/one.md": "# One\n", "https://i.t/b/two.md": "two", "https://i.t/top.md": "top"}
    store = SnapshotStore(spark, f"file://{tmp_path}/i")
    assert counts(spark, spec, store, pages, index_pages=True) == {"added": 6}
    state = {r["key"]: r["content"] for r in store.read().collect()}
    assert state["a/README.md"] == "own" and state["README.md"] == "# i\n\n- [a](a/README.md): 2 pages\n- [b](b/README.md): 1 pages\n- [Top](top.md)\n" and state["b/README.md"] == "# b\n\n1 pages.\n\n- [Two](two.md)\n"
    # Without index pages a run leaves them alone; with them, what is gone goes from them.
    fewer = {**pages, spec.url: pages[spec.url].replace("- [Two](/b/two.md)\n", "")}
    assert counts(spark, spec, store, fewer) == {"unchanged": 3, "removed": 1} and store.read().filter("key = 'b/README.md'").count() == 1
    assert counts(spark, spec, store, fewer, index_pages=True) == {"unchanged": 3, "updated": 1, "removed": 1}


def test_a_manual_of_several_pages(spark, tmp_path):
    """Parts and chapters of one page, sections of another: sections of a section stay in it; the pages' validators are kept."""
    spec = SourceSpec("n", "fixed", (), "slices", "https://n.t/stable/", token="etag", failure="abort", also=("https://n.t/stable/notes",), strip="stable", kinds=((("part",), ("chapter",)), (("section",),)))
    manual = '<div class="part"><h1 id="p">P</h1><div class="chapter"><h2 id="c">C</h2><div class="section"><h3 id="s">S</h3>see <a href="#p">p</a></div></div></div>'
    notes = '<div class="appendix"><div class="section"><h2 id="r1">R1</h2><div class="section"><h3 id="h">H</h3><p>high</p></div></div><div class="section"><h2 id="r2">R2</h2></div></div>'
    store = SnapshotStore(spark, f"file://{tmp_path}/n")
    pages = {spec.url: (200, manual, '"m1"'), spec.also[0]: (200, notes, '"n1"')}
    assert counts(spark, spec, store, pages) == {"added": 4}
    state = {r["key"]: r["content"] for r in store.read().collect()}
    assert sorted(state) == ["notes/r1.md", "notes/r2.md", "p.md", "p/c.md"] and "high" in state["notes/r1.md"] and "[p](../p.md#p)" in state["p/c.md"]
    assert counts(spark, spec, store, {**pages, spec.also[0]: (200, notes.split('<div class="section"><h2 id="r2"')[0], '"n2"')}) == {"unchanged": 3, "removed": 1}
