"""A key holding a third of all rows: results stay exact (checked against a
pandas brute force) and the plans reduce the hot key before any shuffle."""

from pyspark.sql import functions as F

from aidspark.functions.money import MONEY
from aidspark.operators import marts as M
from aidspark.operators.clean import clean_aid
from aidspark.operators.dedup import dedup_keep_last
from aidspark.schemas import AID_DEDUP_KEY
from aidspark.sources import standin as S
from tests.conftest import SF_SMALL


def _hot(spark):
    """Stand-in rows where one firm (and one dedup key) holds a third of them."""
    raw = S.aid_raw(spark, SF_SMALL, with_arrival=True)
    hot = F.abs(F.hash("cor", "id_componente")) % 3 == 0
    return (raw.withColumn("codice_fiscale_beneficiario",
                           F.when(hot, F.lit("HOT")).otherwise(F.col("codice_fiscale_beneficiario")))
            .withColumn("cor", F.when(hot, F.lit("HOT")).otherwise(F.col("cor")))
            .withColumn("id_componente", F.when(hot, F.lit("1")).otherwise(F.col("id_componente")))
            .withColumn("cod_strumento", F.when(hot, F.lit("A")).otherwise(F.col("cod_strumento"))))


def test_hot_key_dedup_matches_brute_force(spark):
    df = _hot(spark)
    n_hot = df.where(F.col("cor") == "HOT").count()
    assert n_hot * 4 > df.count()  # about a third
    got = dedup_keep_last(df, AID_DEDUP_KEY, "_arrival")
    pdf = df.withColumn("_order", F.col("_arrival")).toPandas()
    pdf["_o"] = pdf["_order"].apply(lambda r: tuple(r))
    want = pdf.sort_values("_o").groupby(list(AID_DEDUP_KEY), sort=False).tail(1)
    g = {(r.cor, r.id_componente, r.cod_strumento): r.car for r in got.collect()}
    w = {tuple(k): c for k, c in zip(want[list(AID_DEDUP_KEY)].values.tolist(), want["car"])}
    assert g == w
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan  # reduced map-side before the shuffle


def test_hot_firm_mart_matches_brute_force(spark):
    clean = clean_aid(_hot(spark).drop("_arrival"))
    got = {(r.anno, r.regione_beneficiario): (r.imprese, r.aiuti, r.totale_esl)
           for r in M.mart_per_regione(clean).collect()}
    p = clean.where(F.col("regione_beneficiario") != "ND").select(
        "anno", "regione_beneficiario", "codice_fiscale_beneficiario",
        F.col("elemento_aiuto").cast(MONEY).alias("e")).toPandas()
    agg = p.groupby(["anno", "regione_beneficiario"]).agg(
        imprese=("codice_fiscale_beneficiario", "nunique"), aiuti=("e", "size"), tot=("e", "sum"))
    from decimal import ROUND_HALF_UP, Decimal
    want = {k: (int(r.imprese), int(r.aiuti), float(Decimal(r.tot).quantize(Decimal(1), ROUND_HALF_UP)))
            for k, r in agg.iterrows()}
    assert got == want
