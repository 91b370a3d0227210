"""Keep-last by grant works where the join with the orders dealt the rows."""

from aidspark.operators.dedup import dedup_keep_last
from aidspark.schemas import AID_DEDUP_KEY
from aidspark.sources import standin as S
from tests.conftest import SF_SMALL


def test_keep_last_needs_no_shuffle_of_its_own(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        df = dedup_keep_last(S.aid_raw(spark, SF_SMALL, with_arrival=True), AID_DEDUP_KEY, "_arrival")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    assert "SortMergeJoin [l_orderkey_cor" in plan and "id_componente" not in "".join(
        line for line in plan.splitlines() if "Exchange" in line)
