"""Sources end to end, crawls, the command line, against DuckDB or by their rules."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessaline.plans import cli, landed, run
from tessaline.plans.store import SnapshotStore
from tessaline.plans.sync import Options, SourceFailed
from tessaline.sources import crawl as W
from tessaline.sources import transport as N
from tessaline.sources.registry import SOURCES, SourceSpec

from .conftest import compare, duck

NAMES = [n for n, f in entry.queries().items() if f.__module__ == landed.__name__]
PAGE = "url string, body string, etag string"


@pytest.mark.parametrize("name", NAMES)
def test_landed_queries(spark, name, small):
    compare(entry.queries()[name](spark, small).toPandas(), duck(small).execute(entry.oracle_sql()[name]).df())


def site(spark, pages):
    return spark.createDataFrame([(u, b, None) for u, b in pages.items()], PAGE)


def test_every_source_names_what_there_is():
    for spec in SOURCES.values():
        run.check(spec)
        assert len(run.parts_of(spec)) >= 1
    with pytest.raises(ValueError, match="can't be run"):
        run.check(SourceSpec("x", "fixed", (), "no_such_converter", ""))


def test_failures_of_sources(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    spec = SourceSpec("s", "link_index", (), "preamble", "https://s.test/llms.txt")
    index, page = "## A\n- [One](/a.md)\n- [Two](/b.md)\n", "Text"
    full = {spec.url: index, "https://s.test/a.md": page, "https://s.test/b.md": page}
    assert run.run_source(spark, spec, store, run.landed(site(spark, full))).counts == {"added": 2}
    # A page that fails keeps its content; an index that fails changes nothing and removes nothing.
    broken = lambda asked: run.landed(site(spark, full))(asked).withColumn("status", F.when(F.col("url").endswith("b.md"), 500).otherwise(F.col("status"))).withColumn("body", F.when(F.col("status") == 200, F.col("body")))
    assert run.run_source(spark, spec, store, broken).counts == {"unchanged": 1, "preserved": 1}
    for failure in ("page", "scope", "abort"):
        with pytest.raises(SourceFailed):
            run.run_source(spark, SourceSpec(**{**spec.__dict__, "failure": failure}), store, run.landed(site(spark, {"x": "y"})))
    with pytest.raises(SourceFailed):
        run.run_source(spark, SourceSpec(**{**spec.__dict__, "failure": "abort"}), store, broken)
    assert store.read().count() == 2
    with pytest.raises(RuntimeError, match="at least"):
        run.run_source(spark, SourceSpec(**{**spec.__dict__, "least_rows": 3}), store, run.landed(site(spark, full)))
    assert run.run_source(spark, spec, store, run.landed(site(spark, {k: v.replace("- [Two](/b.md)\n", "") for k, v in full.items()})), Options(limit=1)).counts == {"unchanged": 1}
    assert run.run_source(spark, spec, store, run.landed(site(spark, {k: v.replace("- [Two](/b.md)\n", "") for k, v in full.items()}))).counts == {"unchanged": 1, "removed": 1}


def test_a_source_of_several_parts(spark, tmp_path):
    spec = SourceSpec("p", "fixed+sitemap_by_path", (), "endpoint_documents+html_to_markdown:readme", "https://p.test/openapi.json", also=("https://p.test/sitemap.xml",))
    pages = {spec.url: json.dumps({"openapi": "3.0.0", "paths": {"/a": {"get": {"tags": ["T"], "summary": "A"}}}}), spec.also[0]: "<urlset><url><loc>https://p.test/docs/x</loc></url></urlset>", "https://p.test/docs/x": "<main><h1>X</h1><p>y</p></main>"}
    store = SnapshotStore(spark, f"file://{tmp_path}/p")
    assert run.run_source(spark, spec, store, run.landed(site(spark, pages))).counts == {"added": 2}
    assert {r["key"]: r["content"].split("\n")[0] for r in store.read().collect()} == {"t/get-a.md": "# A", "docs/x.md": "# X"}
    # One part's index is gone: what it had stays.
    assert run.run_source(spark, spec, store, run.landed(site(spark, {k: v for k, v in pages.items() if "sitemap" not in k}))).counts == {"unchanged": 1}
    assert store.read().count() == 2


def test_transports_run_in_tasks(spark, tmp_path):
    spec = SourceSpec("t", "link_index", (), "preamble", "https://t.test/llms.txt", policy="linear")

    def send(url, headers):
        if headers.get("Cookie") != "k=v":
            return N.Reply(403)
        return N.Reply(200, {"https://t.test/llms.txt": b"- [A](/a.md)", "https://t.test/a.md": b"# A\n\nx"}.get(url, b"?"))

    out = run.run_source(spark, spec, SnapshotStore(spark, f"file://{tmp_path}/t"), run.online("once", {"Cookie": "k=v"}, send))
    assert out.counts == {"added": 1}


def test_crawls(spark):
    """Depth and order at first sight, cycles, lost pages, pages that are known."""
    pages = {"r": "a b r", "a": "c b", "b": "d", "c": "a", "e": "r"}
    web = site(spark, pages).withColumn("etag", F.col("url"))
    links = lambda p: p.select("url", F.posexplode(F.split(F.col("body").cast("string"), " ")).alias("ord", "target"))
    roots = spark.createDataFrame([("r", 5), ("r", 0)], "url string, ord int")
    got = W.crawl(roots, run.landed(web), links).orderBy("depth", "place").collect()
    assert [(r["url"], r["depth"], r["place"], r["status"]) for r in got] == [("r", 0, [0], 200), ("a", 1, [0, 0], 200), ("b", 1, [0, 1], 200), ("c", 2, [0, 0, 0], 200), ("d", 2, [0, 1, 0], 404)]
    known = web.filter("url = 'a'").withColumn("body", F.lit("b e").cast("binary"))
    again = {r["url"]: r["status"] for r in W.crawl(roots, run.landed(web), links, known).collect()}
    assert again == {"r": 200, "a": 304, "b": 200, "d": 404, "e": 200}
    assert W.crawl(roots.limit(0), run.landed(web), links).count() == 0


def test_cursors_that_return_end(spark):
    web = site(spark, {"s1": "s2", "s2": "s1", "t1": ""})
    told = lambda p: p.select("source", F.nullif(F.col("body").cast("string"), F.lit("")).alias("url"))
    got = W.cursor_pages(spark.createDataFrame([("s", "s1"), ("t", "t1"), ("u", "none")], "source string, url string"), run.landed(web), told)
    assert sorted((r["source"], r["page"], r["url"], r["status"]) for r in got.collect()) == [("s", 1, "s1", 200), ("s", 2, "s2", 200), ("t", 1, "t1", 200), ("u", 1, "none", 404)]


def test_access_is_verified():
    send = lambda url, headers: N.Reply(200, b"hello") if headers.get("Cookie") == "k=v" else N.Reply(302, None, {"location": "/login"})
    N.verify_access("https://x.test/", {"Cookie": "k=v"}, send)
    for headers, signed_in in (({}, bool), ({"Cookie": "old"}, bool), ({"Cookie": "k=v"}, lambda r: b"sign out" in r.body)):
        with pytest.raises(N.AccessDenied):
            N.verify_access("https://x.test/", headers, send, signed_in=signed_in)


def test_manifests_that_landed_are_reused(spark, tmp_path):
    from tessaline.plans.store import reused

    calls = []
    make = lambda: calls.append(1) or spark.range(3 * len(calls))
    where = f"file://{tmp_path}/m"
    assert [(reused(spark, where, make, h)[0].count(), reused(spark, where, make)[1]) for h in (24, None, 0)] == [(3, True), (3, True), (6, True)] and len(calls) == 2


def test_command_line(spark, tmp_path, capsys):
    c = cli.parse(["anthropic", "cloudf", "--dry-run", "--force", "--limit", "3", "--verbose", "--", "--scope", "docs/", "--odd", "1"])
    assert [s.name for s in c.specs] == ["anthropic", "cloudflare"] and c.options.dry_run and c.options.force and c.options.limit == 3 and c.verbose and c.rest == ("--odd", "1") and c.options.scope is not None
    assert len(cli.parse(["--all"]).specs) == sum(bool(s.url) and not s.requires_auth for s in SOURCES.values()) == 36
    assert cli.parse(["circleci", "--host", "own.test"]).specs[0].url == "https://own.test/api/v2/openapi.json" and cli.parse(["kandji", "--spec-url", "https://k.test/x"]).specs[0].url == "https://k.test/x"
    assert cli.parse([], pick=lambda names: [names[0]]).specs[0].name == sorted(SOURCES)[0]
    for bad in (["nosuch"], ["o"], [], ["anthropic", "--limit", "0"], ["kandji"], ["sentinelone", "--base-url", "https://s.test"], ["anthropic", "discord", "--host", "x"], ["--wrong"]):
        assert cli.main(bad, spark) == 2, bad
    capsys.readouterr()
    lines = []
    assert cli.main(["--list"], spark, show=lines.append) == 0 and len(lines) == 38
    pages = {SOURCES["ollama"].url: "- [A](/a.md)\n", "https://docs.ollama.com/a.md": "# A\n\nx"}
    lines.clear()
    assert cli.main(["ollama", "circleci", "--state", f"file://{tmp_path}", "--verbose"], spark, run.landed(site(spark, pages)), lines.append) == 1
    assert lines[0] == "ollama: 1 added" and lines[1].startswith("circleci: failed") and lines[2] == "  ollama: added a.md"
