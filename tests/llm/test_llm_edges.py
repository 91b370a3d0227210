"""Every operator on hostile rows, empty tables and clashing columns."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import llm_cases as cases  # noqa: E402

import corpus_pipeline  # noqa: E402
from aidspark.llm import (bm25, divergence, hpylm, licenses, packing, qda, rlz, setsketch, toxicity,  # noqa: E402
                          winnow)


def _toxic(docs, labels):
    return toxicity.score(docs, toxicity.fit(docs, labels, "toxic"))


PER_ROW = {
    "hpylm": lambda d, labels, items: hpylm.score(d),
    "rlz": lambda d, labels, items: rlz.remove_duplicates(d),
    "qda": lambda d, labels, items: qda.classify(d, labels, "quality"),
    "divergence": lambda d, labels, items: divergence.judge(d),
    "setsketch": lambda d, labels, items: setsketch.near_duplicates(d),
    "licenses": lambda d, labels, items: licenses.scan(d),
    "toxicity": lambda d, labels, items: _toxic(d, labels),
    "winnow": lambda d, labels, items: winnow.dedup_lines(d),
}


@pytest.fixture(scope="module")
def edge(spark):
    texts, ids = cases.edge_texts()
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 1), (6, 0, 1), (7, 1, 0), (8, 0, 1), (9, None, None), (None, 1, 1),
                                    (10, 1, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (3, "one"), (None, "of the river stone cloud.")],
                                  "item_id long, text string")
    return cases.table(spark, texts, ids).cache(), labels, items


@pytest.fixture(scope="module")
def nothing(spark, edge):
    docs, labels, items = edge
    return docs.limit(0), labels.limit(0), items.limit(0)


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_each_on_hostile_rows(edge, name):
    docs, _, _ = edge
    got = PER_ROW[name](*edge)
    ids = lambda d: sorted((r[0] is None, r[0] or 0) for r in d.select("doc_id").collect())
    assert ids(got) == ids(docs)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(nothing, name):
    assert PER_ROW[name](*nothing).collect() == []


@pytest.mark.parametrize("name", ["qda", "toxicity"])
def test_no_labels(edge, name):
    docs, labels, items = edge
    got = PER_ROW[name](docs, labels.limit(0), items).select("score").distinct().collect()
    assert [r.score for r in got] == [0.5]


def test_packing_edges(edge, nothing):
    docs, _, _ = edge
    got = packing.pack(docs).collect()
    assert sum(r.length for r in got if r.start == 0 and r.doc_tokens == 1) == 4  # null, empty and blank texts
    assert packing.pack(nothing[0]).collect() == []


def test_bm25_edges(edge, nothing):
    docs, _, items = edge
    got = bm25.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(3, 3), (4, 3)}
    assert all(r.doc_id not in (0, 1, 2) for r in got)
    assert bm25.contaminated(docs, nothing[2]).collect() == []
    assert bm25.contaminated(nothing[0], items).collect() == []


def test_pipeline_stages_on_hostile_rows(spark, edge, tmp_path):
    docs, labels, items = edge
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "packing"]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, columns = now.count(), now.columns
        now = stage(spark, now, str(tmp_path)).cache()
        if name != "packing":
            assert now.columns == columns
            assert 0 < now.count() <= before
    assert now.count() > 0


def test_pipeline_on_empty_tables(spark, nothing, tmp_path):
    for name, df in zip(("documents", "labels", "benchmark"), nothing):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_null_rows_have_defined_results(edge):
    docs, _, _ = edge
    got = {r.doc_id: r for r in licenses.scan(docs).filter("doc_id < 3").collect()}
    assert all(got[i].n_words == 0 and got[i].places == [] and got[i].score == 0.0 for i in range(3))
    got = {r.doc_id: r for r in divergence.judge(docs).filter("doc_id < 3").collect()}
    assert all(got[i].n_words == 0 and got[i].base_failed and not got[i].kept for i in range(3))
    got = {r.doc_id: r for r in setsketch.near_duplicates(docs).filter("doc_id < 3").collect()}
    assert all(got[i].n_shingles == 0 and got[i].component_id == i and got[i].first for i in range(3))
    kept = winnow.dedup_lines(docs).filter(F.col("doc_id") == 0).first()
    assert kept.text is None and kept.line_dedup.n_lines == 0
