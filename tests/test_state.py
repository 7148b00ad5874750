"""The snapshot state machine: transitions, failures, gates, idempotence."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessaline.operators import state as S
from tessaline.plans.store import SnapshotStore
from tessaline.plans.sync import Options, SourceFailed, export_markdown, recovered, remove_exported, run_sources, synchronise, version_tasks


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def world(spark, pages, bodies, calls=None):
    """A manifest of pages {key: token} and a fetch that answers from bodies {key: text or status}."""
    manifest = spark.createDataFrame(list(pages.items()), "key string, token string")

    def fetch(wanted):
        if calls is not None:
            calls.append(sorted(r["key"] for r in wanted.select("key").collect()))
        table = spark.createDataFrame([(k, v if isinstance(v, int) else 200, v if isinstance(v, str) else None) for k, v in bodies.items()] or [("", 0, None)], "k string, status int, body string")
        return wanted.join(table, F.col("key") == F.col("k"), "left").select("key", F.coalesce("status", F.lit(0)).alias("status"), "body")

    convert = lambda got: got.select("key", F.lit("T").alias("title"), F.when(F.col("body") != "bad", F.concat(F.lit("# "), F.col("body"))).alias("content"))
    return manifest, fetch, convert


def test_classify_counts_every_key_once(spark):
    old = spark.createDataFrame([("a", "1", True), ("b", "1", True), ("c", "1", True), ("d", "1", False)], "key string, sha256 string, exists boolean")
    new = spark.createDataFrame([("b", "1"), ("c", "2"), ("d", "1"), ("e", "1")], "key string, sha256 string")
    assert rows(S.classify(old, new, exists="exists"), "key", "status") == [("a", "removed"), ("b", "unchanged"), ("c", "updated"), ("d", "added"), ("e", "added")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.dictionaries(st.sampled_from("abcdef"), st.sampled_from("12")), new=st.dictionaries(st.sampled_from("abcdef"), st.sampled_from("12")))
def test_statuses_partition_the_keys(spark, old, new):
    frame = lambda d: spark.createDataFrame(list(d.items()), "key string, sha256 string")
    got = S.classify(frame(old), frame(new)).collect()
    assert sorted(r["key"] for r in got) == sorted({*old, *new})
    expected = lambda k: "added" if k not in old else "removed" if k not in new else "unchanged" if old[k] == new[k] else "updated"
    assert all(r["status"] == expected(r["key"]) for r in got)


def test_run_then_rerun_changes_nothing(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    calls: list = []
    run = lambda pages, bodies, **o: synchronise(*world(spark, pages, bodies, calls), store, Options(**o))
    assert run({"a": "1", "b": "1"}, {"a": "A", "b": "B"}).counts == {"added": 2}
    before = rows(store.read(), "key", "sha256", "last_updated")
    assert run({"a": "1", "b": "1"}, {"a": "X", "b": "X"}).counts == {"unchanged": 2}
    assert rows(store.read(), "key", "sha256", "last_updated") == before and calls[-1] == []
    # Another token, the same text: fetched, unchanged. Another text: updated. A page less: removed.
    assert run({"a": "2", "c": "1"}, {"a": "A2", "c": "C"}).counts == {"updated": 1, "added": 1, "removed": 1}
    assert rows(store.read(), "key", "content") == [("a", "# A2"), ("c", "# C")]


def test_failures_preserve_and_gone_pages_go(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    run = lambda pages, bodies, **o: synchronise(*world(spark, pages, bodies), store, Options(**o))
    run({"a": "1", "b": "1", "c": "1"}, {"a": "A", "b": "B", "c": "C"})
    out = run({"a": "2", "b": "2", "c": "2", "d": "1"}, {"a": 500, "b": 404, "c": "bad", "d": 500})
    assert out.counts == {"preserved": 2, "removed": 1, "failed": 1}
    assert rows(store.read(), "key", "content") == [("a", "# A"), ("c", "# C")]
    # What was preserved is asked for again.
    assert run({"a": "2", "c": "2"}, {"a": "A2", "c": "C2"}).counts == {"updated": 2}


def test_gates_and_dry_runs(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    run = lambda pages, bodies, **o: synchronise(*world(spark, pages, bodies), store, Options(**o))
    run({"a": "1", "b": "1"}, {"a": "A", "b": "B"})
    first = store.current()
    assert run({"a": "1"}, {}, dry_run=True).counts == {"unchanged": 1, "removed": 1} and store.current() == first
    assert run({"a": "1"}, {}, complete=False).counts == {"unchanged": 1}
    assert run({"a": "1", "b": "1"}, {}, limit=1).counts == {"unchanged": 1}
    assert run({"a": "1", "b": "1"}, {}, scope=F.col("key") == "a").counts == {"unchanged": 1}
    assert rows(store.read(), "key") == [("a",), ("b",)]
    with pytest.raises(RuntimeError):
        run({"a": "1"}, {}, least_rows=2)
    with pytest.raises(SourceFailed):
        run({"a": "9", "b": "1"}, {"a": 500}, abort_on_failure=True)
    assert rows(store.read(), "key", "content") == [("a", "# A"), ("b", "# B")]
    # force asks for all, and still finds removals; another engine version invalidates.
    assert run({"a": "1"}, {"a": "A"}, force=True, archive=True).counts == {"unchanged": 1, "deprecated": 1}
    assert run({"a": "1"}, {"a": "A3"}, engine="2").counts == {"updated": 1}
    # What was archived stays, with its content.
    assert rows(store.read(), "key", "content") == [("a", "# A3"), ("deprecated/b", "# B")]
    assert run({"a": "1"}, {}, engine="2").counts == {"unchanged": 1} and store.read().count() == 2


def test_sources_run_one_by_one(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")

    def bad():
        raise SourceFailed("down")

    runs = {"x": bad, "y": lambda: synchronise(*world(spark, {"a": "1"}, {"a": "A"}), store)}
    assert [(r["source"], r["ok"], r["counts"]) for r in run_sources(spark, runs).collect()] == [("x", False, {}), ("y", True, {"added": 1})]
    with pytest.raises(SourceFailed):
        run_sources(spark, runs, stop=True)
    planned = spark.createDataFrame([("a", None), ("z", "own")], "key string, title string")
    assert rows(recovered(planned, store.read(), "title", r"(?m)^# (.+)$"), "key", "title") == [("a", "A"), ("z", "own")]
    index = spark.createDataFrame([("api", ["v1", "v2"])], "api string, specs array<string>")
    assert rows(version_tasks(index), "api", "ord", "spec") == [("api", 0, "v1"), ("api", 1, "v2")]


def test_missing_outputs_are_added_again_and_fast_paths_refused(spark):
    state = spark.createDataFrame([("a", "1", False), ("b", "1", True)], "key string, token string, exists boolean")
    plan = S.plan_changes(spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "key string, token string"), state, exists="exists")
    assert rows(plan.fillna("", ["reason"]), "key", "reason") == [("a", "missing output"), ("b", ""), ("c", "new")]
    sources = spark.createDataFrame([("s", "f", "f"), ("t", "f", "g"), ("u", "f", "f")], "source string, fingerprint string, new_fingerprint string")
    outputs = spark.createDataFrame([("s", True), ("s", True), ("t", True)], "source string, exists boolean")
    assert rows(S.fast_path(sources, outputs), "source", "skip") == [("s", True), ("t", False), ("u", False)]


def test_store_keeps_the_version_that_is_read(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    assert store.current() is None and store.read() is None
    store.commit(spark.range(3))
    old = store.read()
    store.commit(spark.range(5).union(old))
    assert old.count() == 3 and store.read().count() == 8
    store.commit(spark.range(1))
    store.prune(1)
    assert len(store.versions()) == 1 and store.read().count() == 1


def test_export_and_removal_of_files(spark, tmp_path):
    state = spark.createDataFrame([("x/y/a.md", "A"), ("b.md", "ü")], "key string, content string")
    assert rows(export_markdown(state, f"file://{tmp_path}"), "path", "bytes") == [("b.md", 2), ("x/y/a.md", 1)]
    assert (tmp_path / "x/y/a.md").read_text() == "A"
    assert rows(remove_exported(state.filter("key <> 'b.md'"), f"file://{tmp_path}"), "path", "removed") == [("x/y/a.md", True)]
    assert not (tmp_path / "x").exists() and (tmp_path / "b.md").exists()
