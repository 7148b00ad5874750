"""Queries over tables that are larger than the test tables in the one respect that once made them wrong or slow."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import compare, duck


@pytest.fixture()
def folder(tmp_path):
    """A folder to write a table to, and the query over it against its SQL."""
    import __spark_entry__ as entry

    def put(df, name: str) -> None:
        df.toPandas().to_parquet(tmp_path / f"{name}.parquet")

    def same(spark, name: str) -> None:
        compare(entry.queries()[name](spark, str(tmp_path)).toPandas(), duck(str(tmp_path)).execute(entry.oracle_sql()[name]).df())

    return put, same


def test_numbers_beyond_a_million(spark, folder):
    put, same = folder
    put(spark.createDataFrame([(x,) for x in (1, 999, 1000, 999_999, 1_000_000, 1_250_000, 12_345_678)], "p_partkey bigint"), "part")
    same(spark, "number_humanise")


def test_table_of_many_rows(spark, folder):
    """Its time follows its rows: with the width found anew for each row it took minutes."""
    put, same = folder
    put(spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") * 7 % 1000).alias("n_chars")), "documents")
    began = time.time()
    same(spark, "markdown_table")
    assert time.time() - began < 60


def test_cursors_in_few_rounds(spark, monkeypatch):
    """Chains of any length, one that returns into itself and one that fails are as cursor_pages has them, in as many rounds as 200 has binary digits."""
    from tessaline.plans import run
    from tessaline.sources import crawl as W

    links = {**{f"a{n}": f"a{n + 1}" for n in range(200)}, "a200": "", "b0": "b1", "b1": "b2", "b2": "b3", "b3": "b1", "c0": "none"}
    web = spark.createDataFrame([(u, to, None) for u, to in links.items()], "url string, body string, etag string")
    start = spark.createDataFrame([("a", "a0"), ("z", "a150"), ("b", "b0"), ("c", "c0"), ("n", "none")], "source string, url string")
    told = lambda p: p.select("source", F.nullif(F.col("body").cast("string"), F.lit("")).alias("url"))
    cuts = []
    monkeypatch.setattr(W, "cut_here", lambda df, real=W.cut_here: cuts.append(1) or real(df))
    got = sorted((r["source"], r["page"], r["url"], r["status"]) for r in W.landed_cursor_pages(start, web, run.landed(web), told).collect())
    assert len(cuts) <= 2 + 3 * 9
    want = [("a", n + 1, f"a{n}", 200) for n in range(201)] + [("z", n - 149, f"a{n}", 200) for n in range(150, 201)] + [("b", n + 1, f"b{n}", 200) for n in range(4)] + [("c", 1, "c0", 200), ("c", 2, "none", 404), ("n", 1, "none", 404)]
    assert got == sorted(want)


def test_cursor_replies_of_many_pages(spark, folder):
    """Nine hundred pages of one source; a round for each took ten minutes and more."""
    put, same = folder
    put(spark.range(18_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 90 == 0, "t").otherwise("s").alias("source")), "documents")
    began = time.time()
    same(spark, "cursor_replies")
    assert time.time() - began < 120


def test_folders_are_looked_at_once(spark, tmp_path):
    """Four thousand files of one folder, of which one stays, and a chain of folders: each folder is listed once, whatever number of its files goes."""
    from tessaline.plans import sync

    where, looks = f"file://{tmp_path}/out", tmp_path / "looks"
    files = spark.range(4000).select(F.concat(F.lit("d/f"), "id").alias("key"), F.lit("x").alias("content")).unionByName(spark.createDataFrame([("a/b/c/x", "x"), ("top", "x")], "key string, content string"))
    sync.export_markdown(files, where).count()
    real = sync._is_empty

    def counted(store, folder):
        with open(looks, "a") as f:
            f.write(f"{folder}\n")
        return real(store, folder)

    sync._is_empty = counted
    try:
        got = sync.remove_exported(files.filter("key <> 'd/f7'"), where)
    finally:
        sync._is_empty = real
    assert (got.count(), got.filter("removed").count()) == (4001, 4001)
    assert sorted(p.name for p in (tmp_path / "out").rglob("*")) == ["d", "f7"]
    # d, c, b, a, and the parents are seen once more where two tasks climb
    assert 2 <= len(looks.read_text().splitlines()) <= 4


def test_runs_read_no_bodies_for_nothing(spark, tmp_path):
    """A second run that wants nothing evaluates no body; one that changes tokens alone keeps the contents."""
    from tessaline.plans.store import SnapshotStore
    from tessaline.plans.sync import Options, synchronise

    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    site = spark.createDataFrame([("a", "1", "A"), ("b", "1", "B")], "key string, token string, body string")
    convert = lambda rows: rows.select("key", F.lit("T").alias("title"), F.col("body").alias("content"))

    def run(body, token, **more):
        fetch = lambda wanted: site.select("key", F.lit(200).alias("status"), body.alias("body")).join(wanted.select("key"), "key", "left_semi")
        return synchronise(site.select("key", F.lit(token).alias("token")), fetch, convert, store, Options(**more)).counts

    assert run(F.col("body"), "1") == {"added": 2}
    assert run(F.when(F.col("body") != "", F.raise_error(F.lit("a body was read"))).otherwise(F.col("body")), "1") == {"unchanged": 2}
    assert run(F.col("body"), "2") == {"unchanged": 2}
    assert sorted((r["key"], r["token"].split("\u0001")[1], r["content"], r["title"]) for r in store.read().collect()) == [("a", "2", "A", "T"), ("b", "2", "B", "T")]


def test_concatenated_pages_of_whole_sources(spark, folder, tmp_path):
    """The rows name the source itself, not a run of its ids; of a url in two slices the last counts."""
    from tessaline.sources import discover as D

    put, same = folder
    put(spark.range(120).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 2).alias("source"), F.concat(F.lit("text "), "id").alias("text")), "documents")
    import __spark_entry__ as entry

    assert {r["source"] for r in entry.queries()["concatenated_pages"](spark, str(tmp_path)).collect()} == {"s0", "s1"}
    same(spark, "concatenated_pages")
    slices = spark.createDataFrame([("s", 2, "# B\nSource: u\nnew"), ("s", 1, "# A\nSource: u\nold\n# C\nSource: v\nx")], "source string, k int, text string")
    assert sorted((r["url"], r["title"], r["body"]) for r in D.concatenated_pages(slices, order="k").collect()) == [("u", "B", "new"), ("v", "C", "x")]


def test_batches_of_converters_are_bounded(spark):
    """A worker is handed few rows at a time, whatever the session's setting was."""
    from tessaline.functions import convert as V

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    made = {"html": lambda: V.html_to_markdown(F.lit("<p>a</p>")), "rst": lambda: V.rst_to_markdown(spark.createDataFrame([("a", "b")], "name string, text string"))}
    for make in made.values():
        spark.conf.set(key, "10000")
        make()
        assert int(spark.conf.get(key)) <= 500 and int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
