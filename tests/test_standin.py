"""The Spark stand-in builders equal their SQL twins (so the oracle starts
from the same input as the engine)."""

from aidspark.schemas import AID_COLUMNS, MEASURE_COLUMNS
from aidspark.sources import standin as S
from tests.conftest import SF_SMALL
from tools.compare import _rows, duck


def _same(spark_df, sql):
    rel = duck(SF_SMALL).sql(sql)
    return _rows(spark_df.columns, spark_df.collect()) == _rows(rel.columns, rel.fetchall())


def test_aid_standin_matches_sql(spark):
    df = S.aid_raw(spark, SF_SMALL)
    assert df.columns == AID_COLUMNS
    assert _same(df, S.AID_RAW_SQL)


def test_measure_standin_matches_sql(spark):
    df = S.measure_raw(spark, SF_SMALL)
    assert df.columns == MEASURE_COLUMNS
    assert _same(df, S.MEASURE_RAW_SQL)


def test_side_tables_match_sql(spark):
    assert _same(S.population(spark, SF_SMALL), S.POPULATION_SQL)
    assert _same(S.cup_bridge(spark, SF_SMALL), S.CUP_BRIDGE_SQL)
    assert _same(S.territory(spark, SF_SMALL), S.TERRITORY_SQL)
