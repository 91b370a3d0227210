"""Keyed joins: no fan-out on repeated car, keys normalised, '' excluded."""

from pyspark.sql import functions as F

from aidspark.operators import joins as J
from aidspark.operators.clean import clean_aid, clean_measure
from aidspark.sources import standin as S
from tests.conftest import SF_SMALL


def test_measure_windows_do_not_fan_out(spark):
    clean = clean_aid(S.aid_raw(spark, SF_SMALL))
    meas = clean_measure(S.measure_raw(spark, SF_SMALL))
    repeated = meas.groupBy("car").count().where("count > 1").select("car")
    assert repeated.count() > 0
    j = J.join_aid_measure(clean, meas)
    assert j.count() == clean.where(F.col("car") != "").select("car").distinct().count()
    direct = clean.groupBy("car").agg(F.count(F.lit(1)).alias("n"))
    assert j.join(direct, "car").where(F.col("aiuti") != F.col("n")).count() == 0
    two = j.join(repeated, "car").select("n_finestre", "data_inizio_misura").collect()
    assert two and all(r.n_finestre == 2 for r in two)
    latest = meas.join(repeated, "car").groupBy("car").agg(F.max("data_inizio_misura").alias("m"))
    assert (j.join(latest, "car").where(F.col("data_inizio_misura") != F.col("m")).count()) == 0


def test_fiscal_code_keys_are_normalised(spark):
    aid = spark.createDataFrame([(" abc1 ", 10.0), ("ABC1", 5.0), ("", 1.0), ("zz", 2.0)],
                                "codice_fiscale_beneficiario string, elemento_aiuto double")
    ent = spark.createDataFrame([("abc1",), ("ABC1 ",), ("",)], "codice_fiscale string")
    r = J.join_by_fiscal_code(aid, ent).collect()
    assert [(x.codice_fiscale, x.aiuti, x.totale_esl, x.n_record_entita) for x in r] == [("ABC1", 2, 15.0, 2)]
