"""The pipeline: each stage against a brute-force version of its decision, and odd tables."""

from __future__ import annotations

import pandas as pd

import corpus_pipeline
from tessaline.llm import mixing, toxicity
from tessaline.llm.common import table

from ..conftest import SMALL
from .test_text_operators import brute_components, brute_contamination, brute_fingerprint, brute_passages


def test_stages_against_brute_force(spark, tmp_path):
    docs, columns = table(spark, SMALL, "documents"), table(spark, SMALL, "documents").columns
    before = docs.toPandas()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, docs.toPandas())
        before = seen[name][1]
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]

    source, kept = seen["toxicity"]
    scores = toxicity.classify(table(spark, SMALL, "documents"), table(spark, SMALL, "labels")).toPandas()
    assert set(kept.doc_id) == set(scores[scores.predicted == 0].doc_id)

    source, kept = seen["near_duplicates"]
    source = source.sort_values("doc_id").reset_index(drop=True)
    roots = brute_components([brute_fingerprint(t) for t in source.text])
    assert sorted(kept.doc_id) == sorted(source.doc_id[r] for r in set(roots))

    source, kept = seen["repeats"]
    want = {i: left.decode() for i, left in zip(source.doc_id, brute_passages(list(source.text), corpus_pipeline.PASSAGE_WORDS), strict=True)}
    assert dict(zip(kept.doc_id, kept.text, strict=True)) == want and (kept.n_chars == kept.text.map(len)).all()

    source, kept = seen["decontamination"]
    items = list(pd.read_parquet(f"{SMALL}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False))
    bad = {i for i, w in zip(source.doc_id, brute_contamination(source.text, items), strict=True) if w[3]}
    assert set(kept.doc_id) == set(source.doc_id) - bad

    source, kept = seen["mixing"]
    assert sorted(kept.doc_id) == sorted(source.doc_id) and abs(kept.taken.sum() - 1.5 * kept["size"].sum()) < kept["size"].max() * kept.source.nunique()


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == mixing.mix(table(spark, SMALL, "documents").limit(0)).columns and got.count() > 0


def test_stages_on_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, __key string, n_bytes long, n_removed string, kept_bytes int, kept_sha256 string, n_spans long"
    rows = [(1, None, None, None, None, "a"), (1, None, None, None, None, "a"), (None, "same text here again", "en", "s", 3, "b"), (None, "same text here again", "en", "s", 3, "b"), (2, "", "en", "s", 0, "c"), (3, "é" * 500, "fr", None, 500, "d"), (4, "é" * 450, "fr", "t", 450, "d")]
    rows = [(*r, 7, "own", 8, "sha", 9) for r in rows]
    empty = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0, name
        docs = spark.createDataFrame(rows, schema)
        out = stage(spark, docs, SMALL)
        if name != "mixing":
            assert out.columns == docs.columns
        assert 0 < out.count() <= len(rows)
        if name != "mixing":
            assert {(r["n_bytes"], r["n_removed"], r["kept_bytes"], r["kept_sha256"], r["n_spans"]) for r in out.collect()} == {(7, "own", 8, "sha", 9)}
