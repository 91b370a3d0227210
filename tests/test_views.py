"""Ad-hoc SQL through the registered views gives the operator's result."""


from aidspark.operators import analysis as A
from aidspark.operators import marts as M
from aidspark.plans import storage as ST
from aidspark.sources import standin as S
from aidspark.sources.views import register_views
from tests.conftest import SF_SMALL
from tools.compare import _rows


def test_sql_over_views_matches_operators(spark, tmp_dir):
    ST.write_year_overwrite(S.aid_raw(spark, SF_SMALL), tmp_dir)
    names = register_views(spark, raw_path=tmp_dir)
    sql = spark.sql(f"""
        SELECT anno, mese, COUNT(*) AS n_aiuti,
               CAST(ROUND(SUM(CAST(elemento_aiuto AS DECIMAL(18,2))), 0) AS DOUBLE) AS totale_mensile
        FROM {names['all_years']} GROUP BY anno, mese""")
    df = A.q_monthly_trend(ST.read_all_years(spark, tmp_dir))
    assert _rows(sql.columns, sql.collect()) == _rows(df.columns, df.collect())
    strum = spark.sql(f"""
        SELECT anno, strumento, COUNT(*) AS aiuti,
               CAST(ROUND(SUM(CAST(elemento_aiuto AS DECIMAL(18,2))), 0) AS DOUBLE) AS totale_esl
        FROM {names['clean']} WHERE strumento IS NOT NULL AND strumento != ''
        GROUP BY anno, strumento""")
    mart = M.mart_per_strumento(spark.table(names["clean"])).select("anno", "strumento", "aiuti", "totale_esl")
    assert _rows(strum.columns, strum.collect()) == _rows(mart.columns, mart.collect())
    pruned = spark.sql(f"SELECT COUNT(*) FROM {names['raw']} WHERE anno = 1997")
    assert "PartitionFilters: [isnotnull(anno" in pruned._jdf.queryExecution().executedPlan().toString()


def test_measure_views(spark, tmp_dir):
    ST.write_year_overwrite(S.aid_raw(spark, SF_SMALL), tmp_dir)
    meas = S.measure_raw(spark, SF_SMALL)
    names = register_views(spark, raw_path=tmp_dir, measures=meas)
    sql = spark.sql(f"""SELECT des_tipo_misura, COUNT(*) AS n_misure FROM {names['measure_clean']}
                        WHERE des_tipo_misura IS NOT NULL GROUP BY des_tipo_misura""")
    mart = M.mart_misure_per_tipo(spark.table(names["measure_clean"])).select("des_tipo_misura", "n_misure")
    assert _rows(sql.columns, sql.collect()) == _rows(mart.columns, mart.collect())
