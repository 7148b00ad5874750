"""Keyed rows, graphs, names: small cases with ties, nulls and cycles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessaline.functions import filters as P
from tessaline.functions import keys as K
from tessaline.functions import text as T
from tessaline.operators import catalogue as C
from tessaline.operators import graph as G
from tessaline.operators import relational as R


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_keys(spark):
    got = one(
        spark, canon=K.canonical_url(F.lit("https://h/docs/a/b.md?x#y"), "https://h/docs"), root=K.canonical_url(F.lit("https://h/docs/"), "https://h/docs"), other=K.canonical_url(F.lit("https://z/a"), "https://h/docs"),
        path=K.url_path(F.lit("https://h/a/b/?q=1")), slash=K.url_path(F.lit("https://h")), slug=K.slug(F.lit("  Héllo,  Wörld -- x_1 ")), none=K.slug(F.lit("!!!")),
        out=K.output_path(F.lit("a b/../c")), rel=K.relative_link(F.lit("a/b/c.md"), F.lit("a/d/e.md")), same=K.relative_link(F.lit("a/c.md"), F.lit("a/d.md")), absolute=K.absolute_link(F.lit("../x"), F.lit("https://h/a/b?q")),
        proto=K.absolute_link(F.lit("//z/x"), F.lit("https://h/a")), hosted=K.absolute_link(F.lit("/x"), F.lit("https://h/a/b")), quoted=K.percent_encoded(F.lit("a b/ü")), title=K.derive_title(F.lit("mcp-servers"), ["MCP"]),
        translated=K.translated_title(F.lit("Guide (Español)"), ["Español"]), parents=K.parent_paths(F.lit("a/b/c")), tags=K.tags_or(F.array().cast("array<string>")))
    assert got == {
        "canon": "https://h/docs/a/b", "root": None, "other": None, "path": "a/b", "slash": "/", "slug": "héllo-wörld-x_1", "none": "misc", "out": "a-b/c.md", "rel": "../d/e.md", "same": "d.md", "absolute": "https://h/a/../x",
        "proto": "https://z/x", "hosted": "https://h/x", "quoted": "a%20b/%C3%BC", "title": "MCP Servers", "translated": True, "parents": ["a", "a/b"], "tags": ["Untagged"]}


def test_texts(spark):
    page = "---\ntitle: 'A B'\ntags:\n  - x\n  - \"y\"\n---\nBody"
    got = one(
        spark, title=T.front_value(F.lit(page), "title"), tags=T.front_list(F.lit(page), "tags"), flow=T.front_list(F.lit("---\ntags: [a, 'b']\n---\n"), "tags"), body=T.without_front_matter(F.lit(page)),
        plain=T.plain_text(F.lit("<nav>no</nav><p>A &amp;&lt; <b>b</b><script>x</script>")), span=T.code_span(F.lit("a`b")), fence=T.fenced(F.lit("x\n````\ny"), F.lit("md")), cap=T.capped(F.lit("x" * 151)),
        blank=T.blank_runs_collapsed(F.lit("a\n\n\n\nb")), table=T.markdown_table(F.array(F.array(F.lit("a"), F.lit("b|c")), F.array(F.lit("1")))), simple=T.html_to_markdown_simple(F.lit("<h2>T</h2><p>a <b>b</b> <a href='/x'>l</a></p><ul><li>i</li></ul>")),
        pre=T.with_preamble(F.lit("# T\n\nx"), F.lit("T"), F.lit("u")), number=T.short_number(F.lit(1_250_000)), first=T.first_present(F.lit(None).cast("string"), F.lit(""), F.lit("z")))
    assert got["title"] == "A B" and got["tags"] == ["x", "y"] and got["flow"] == ["a", "b"] and got["body"] == "Body"
    assert got["plain"] == "A &< b" and got["span"] == "``a`b``" and got["fence"] == "`````md\nx\n````\ny\n`````" and len(got["cap"]) == 150 and got["cap"].endswith("x...")
    assert got["blank"] == "a\n\nb" and got["table"] == "| a | b\\|c |\n| --- | --- |\n| 1 |  |" and got["simple"] == "## T\n\na **b** [l](/x)\n\n- i"
    assert got["pre"] == "# T\n\nSource: u\n\nx\n" and got["number"] == "1.3M" and got["first"] == "z"


def test_predicates(spark):
    got = one(
        spark, hl=P.has_parameter(F.lit("https://h/a?b=1&hl=de"), "hl"), none=P.has_parameter(F.lit("https://h/hl=de"), "hl"), out=P.matches_none(F.lit("a/sdk/x"), ["/sdk/"]), kept=P.matches_none(F.lit(None).cast("string"), ["x"]),
        house=P.housekeeping_category(F.lit("Pages with broken links")), lang=P.housekeeping_category(F.lit("Audio (Español)"), languages=["Español"]), real=P.housekeeping_category(F.lit("Audio")),
        draft=P.published(F.lit("True")), no_draft=P.published(F.lit(None).cast("string")), long=P.long_enough(F.lit(" " * 60 + "x")), null=P.long_enough(F.lit(None).cast("string")), page=P.is_markup_page(F.lit(" <!DOCTYPE html><p>")), script=P.is_markup_page(F.lit("var x")))
    assert got == {"hl": True, "none": False, "out": False, "kept": True, "house": True, "lang": True, "real": False, "draft": False, "no_draft": True, "long": False, "null": False, "page": True, "script": False}


def test_wins_and_ties(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None), (None, 1, "n"), (None, 0, "m")], "k string, o int, v string")
    assert {(r["k"], r["v"]) for r in R.first_wins(df, ["k"], ["o"]).collect()} == {("a", "y"), ("b", None), (None, "m")}
    assert {(r["k"], r["v"]) for r in R.last_wins(df, ["k"], ["o"]).collect()} == {("a", "x"), ("b", None), (None, "n")}
    versions = spark.createDataFrame([("a", "2.0", 3), ("a", "2.0", 1), ("a", "1.0", 2)], "k string, v string, t int")
    assert rows(R.best_of(versions, ["k"], "v", "t"), "k", "v", "t") == [("a", "2.0", 1)]


def test_names_made_unique_even_where_a_made_name_is_taken(spark):
    df = spark.createDataFrame([("g", "x", 1), ("g", "x", 2), ("g", "x-2", 3), ("g", "x", 4), ("h", "x", 5)], "g string, n string, o int")
    got = {r["o"]: r["unique_name"] for r in R.decollided(df, "g", "n", "o").collect()}
    assert got == {1: "x", 2: "x-3", 3: "x-2", 4: "x-4", 5: "x"}


def test_names_made_unique_beside_long_runs_of_taken_names(spark):
    names = ["x", "x", *[f"x-{k}" for k in range(2, 40)], "x", "x-41", "x", "x", "x-2", "x-07", None, None, "2"]
    df = spark.createDataFrame([("g", n, o) for o, n in enumerate(names)], "g string, n string, o int")
    got = {r["o"]: r["unique_name"] for r in R.decollided(df, "g", "n", "o").collect()}
    assert len(got) == len(names) == len(set(got.values()))
    assert (got[0], got[1], got[40], got[42], got[43], got[44], got[46], got[47]) == ("x", "x-40", "x-42", "x-43", "x-44", "x-2-2", None, "3")


def test_graph_with_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("b", None)], "src string, dst string")
    roots = spark.createDataFrame([("a",)], "node string")
    assert rows(G.reachable(edges, roots), "node", "depth") == [("a", 0), ("b", 1), ("c", 2)]
    nodes = spark.createDataFrame([(n,) for n in "abcxy"], "node string")
    assert rows(G.orphans(nodes, edges, roots), "node") == [("x",), ("y",)]
    edges.filter("dst IS NOT NULL").createOrReplaceTempView("e")
    roots.createOrReplaceTempView("r")
    assert rows(G.reachable_sql(spark, "e", "r"), "node", "depth") == [("a", 0), ("b", 1), ("c", 2)]


def test_graph_loops_have_no_last_round(spark, monkeypatch):
    chain = spark.createDataFrame([(k, k - 1 if k else None, f"n{k}") for k in range(104)] + [(0, 1, "again")], "id int, parent int, name string").coalesce(1)
    got = {r["id"]: (r["depth"], len(r["path"])) for r in G.flattened(chain).collect()}
    assert got == {k: (k, k + 1) for k in range(104)}
    # A frontier that is never empty before round 1,003: no cut, and no Spark job, in between.
    class Rounds:
        n = 0

        def __getattr__(self, _):
            return lambda *a, **k: self

        def __getitem__(self, _):
            return F.lit(0)

        def isEmpty(self):
            Rounds.n += 1
            return Rounds.n == 1003

    monkeypatch.setattr(G, "cut_here", lambda df: df)
    fake = Rounds()
    fake.columns = ["node"]
    G.reachable(fake, fake)
    assert Rounds.n == 1003


def test_fingerprints_do_not_depend_on_order(spark):
    a = spark.createDataFrame([("s", 1, "x"), ("s", 2, None)], "s string, n int, v string")
    b = a.orderBy(F.desc("n")).repartition(3)
    get = lambda df, e="": C.fingerprint(df, ["s"], ["n", "v"], e).first()["fingerprint"]
    assert get(a) == get(b) and get(a) != get(a, "2") and get(a) != get(a.fillna("x"))


def test_aliases_ranges_and_display(spark):
    index = spark.createDataFrame([("/a/overview", "A"), ("/b", "B"), ("/c/overview", "C")], "url string, title string")
    pages = spark.createDataFrame([("/a",), ("/b",), ("/c/overview",)], "url string")
    assert rows(R.remapped_aliases(index, pages), "url") == [("/a",), ("/b",), ("/c/overview",)]
    tokens = spark.createDataFrame([("3-5",), ("7",), ("x",)], "t string")
    assert rows(R.expand_ranges(tokens, "t"), "number") == [(3,), (4,), (5,), (7,)]
    assert one(spark, x=R.shown(F.array(*[F.lit(str(k)) for k in range(5)]), 3))["x"] == ["0", "1", "2", "... and 2 more"]
