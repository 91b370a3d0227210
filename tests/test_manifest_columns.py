"""The deduplication of the index reads what the manifest counts and nothing else."""

from conftest import SF_SMALL

from aidspark import queries as Q


def test_index_deduplicates_counted_columns_only(spark):
    for q in (Q.q_manifest_index, Q.q_manifest_totals):
        plan = q(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "o_orderdate" in plan
        assert "titolo_misura" not in plan and "soggetto_concedente" not in plan
