"""The line deduplication of the pipeline cuts every text once a step: a second
evaluation in a stage keeps a second worker for every task."""

import pytest

pytest.importorskip("xxhash")

import llm_cases as cases  # noqa: E402

import corpus_pipeline  # noqa: E402


def evaluations(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("EvalPython")


def test_texts_are_cut_once(spark, monkeypatch):
    found, real = [], corpus_pipeline.materialize

    def record(df, name):
        found.append(evaluations(df))
        return real(df, name)
    monkeypatch.setattr(corpus_pipeline, "materialize", record)
    same = " ".join(f"w{i}" for i in range(60))
    docs = cases.table(spark, ["a\nb\nc", "a\nb\nd", "a\nb", same, "x " + same, None], [1, 2, 3, 4, 5, 6])
    out = corpus_pipeline.dedup_lines(spark, docs, "")
    assert found == [1] and evaluations(out) == 1
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a\nb\nc", 2: "d", 4: same, 5: "x ", 6: None}
