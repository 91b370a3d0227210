"""The toxicity sample is cut and hashed in one Python step: each further one in a
stage keeps a worker of its own for every task."""

import pytest

pytest.importorskip("xxhash")

import llm_cases as cases  # noqa: E402

from aidspark.llm import toxicity  # noqa: E402


def test_sample_is_hashed_in_one_python_step(spark, monkeypatch):
    plans, real = {}, toxicity.materialize

    def record(df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return real(df, name)
    monkeypatch.setattr(toxicity, "materialize", record)
    docs = cases.table(spark, [f"word{i % 5} good bad{i % 3} " * 40 for i in range(40)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, "toxic", words_per_class=2_000)
    assert len(model.ratio.words)
    plan = plans["toxic-sample"]
    assert (plan.count("MapInArrow"), plan.count("EvalPython")) == (1, 0)
