"""Relations between marts that must hold on any input."""

from pyspark.sql import functions as F

from aidspark.operators import marts as M
from aidspark.operators.clean import clean_aid
from aidspark.sources import standin as S
from tests.conftest import SF_SMALL


def _clean(spark):
    return clean_aid(S.aid_raw(spark, SF_SMALL))


def _set(df, cols):
    return {tuple(r[c] for c in cols) for r in df.select(*cols).collect()}


def test_shares_sum_to_100_per_partition(spark):
    c = _clean(spark)
    for df, share, part in [(M.mart_per_obiettivo(c), "quota_pct_su_anno", ["anno"]),
                            (M.mart_per_strumento(c), "quota_pct_su_anno", ["anno"]),
                            (M.mart_settore_regione(c), "quota_pct_su_regione", ["anno", "regione"])]:
        sums = df.groupBy(*part).agg(F.sum(share).alias("s"), F.count(F.lit(1)).alias("n")).collect()
        for r in sums:
            assert abs(r.s - 100.0) <= 0.005 * r.n + 1e-9


def test_territory_base_equals_per_region(spark):
    c = _clean(spark)
    t = M.mart_territorio(c).withColumnRenamed("regione", "regione_beneficiario")
    cols = ["anno", "regione_beneficiario", "imprese", "aiuti", "totale_esl", "media_esl"]
    assert _set(t, cols) == _set(M.mart_per_regione(c), cols)


def test_policy_objective_part_equals_per_objective(spark):
    c = _clean(spark)
    p = (M.mart_policy(c).where(F.col("dimensione") == "obiettivo")
         .withColumnRenamed("codice", "cod_obiettivo").withColumnRenamed("descrizione", "obiettivo"))
    cols = ["anno", "cod_obiettivo", "obiettivo", "aiuti", "imprese", "totale_esl", "media_esl", "quota_pct_su_anno"]
    assert _set(p, cols) == _set(M.mart_per_obiettivo(c), cols)


def test_sector_marts_agree_and_ranks_are_dense(spark):
    c = _clean(spark)
    a, b = M.mart_settore_regione(c), M.mart_settori(c)
    assert _set(a, a.columns) == _set(b, b.columns)
    bad = (a.groupBy("anno", "regione").agg(F.max("rank_in_regione").alias("m"), F.count(F.lit(1)).alias("n"))
           .where(F.col("m") != F.col("n")).count())
    assert bad == 0


def test_top_is_bounded_and_ordered(spark):
    top = M.mart_top_beneficiari(_clean(spark), n=50).collect()
    assert len(top) == 50
    assert all(top[i].totale_esl >= top[i + 1].totale_esl for i in range(49))
