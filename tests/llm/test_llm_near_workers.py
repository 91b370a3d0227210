"""Near-duplicate links are estimated and verified in stages of their own: two Python
steps of one stage keep two workers for every task."""

import pytest

pytest.importorskip("xxhash")

import llm_cases as cases  # noqa: E402

from aidspark.llm import setsketch  # noqa: E402


def test_no_plan_has_two_python_steps_of_links(spark, monkeypatch):
    plans, real = [], setsketch.materialize

    def record(df, name):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString().count("MapInArrow")))
        return real(df, name)
    monkeypatch.setattr(setsketch, "materialize", record)
    near = " ".join(f"w{i}" for i in range(80))
    docs = cases.table(spark, [near, near + " x", "other words of a text that stands alone", near], [4, 2, 3, 1])
    got = {r["doc_id"]: r["component_id"] for r in setsketch.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1}
    # the second call's links are a union of two plans
    assert [n for name, n in plans if name == "likely"] == [1, 1]
    assert [n for name, n in plans if name == "links"][0] == 1
