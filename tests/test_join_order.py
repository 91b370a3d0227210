"""Line items move to the orders last (F27): each join before it is narrower."""

from aidspark.sources import standin as S
from tests.conftest import SF_SMALL


def test_orders_meet_customers_before_line_items(spark):
    plan = S.aid_raw(spark, SF_SMALL, with_arrival=True)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 5 and "l_orderkey" in joins[0]
