"""Quality gates (V1-V7) and catalog."""

import pytest

from aidspark.operators import catalog as CT
from aidspark.operators import quality as Q
from aidspark.operators.clean import clean_aid, clean_measure
from aidspark.plans import storage as ST
from aidspark.sources import standin as S
from tests.conftest import SF_SMALL


def test_required_columns_and_tables(spark):
    clean = clean_aid(S.aid_raw(spark, SF_SMALL))
    r = Q.dq_required_columns(spark, clean, Q.AID_CLEAN_RULES["required_columns"] + ["missing"], "clean")
    assert {x.colonna: x.presente for x in r.collect()}["missing"] is False
    t = Q.dq_required_tables(spark, ["mart_aiuti_per_regione"], Q.AID_REQUIRED_MARTS)
    assert {x.tabella: x.presente for x in t.collect()} == {"mart_aiuti_per_regione": True,
                                                          "mart_aiuti_per_obiettivo": False}


def test_not_null_min_rows_and_enforce(spark):
    meas = clean_measure(S.measure_raw(spark, SF_SMALL))
    nn = Q.dq_not_null(meas, ["anno", "importo_aiuto_ad_hoc"], "m").collect()
    by = {r.colonna: r for r in nn}
    assert by["anno"].nulli == 0 and by["anno"].esito
    assert by["importo_aiuto_ad_hoc"].nulli > 0 and not by["importo_aiuto_ad_hoc"].esito
    mr = Q.dq_min_rows(meas, 10 ** 9, "m")
    with pytest.raises(Q.QualityError):
        Q.enforce(mr)
    Q.enforce(mr, fail_on_error=False)


def test_primary_key_finds_repeated_car(spark):
    meas = clean_measure(S.measure_raw(spark, SF_SMALL))
    assert Q.dq_primary_key(meas, Q.MEASURE_CLEAN_RULES["primary_key"]).count() == 0
    assert Q.dq_primary_key(meas, ["car"]).count() > 0


def test_manifest_completeness_rule(spark):
    df = spark.createDataFrame([(2026, m) for m in (1, 2, 3)] + [(2020, m) for m in range(1, 13)]
                               + [(2019, 0), (2019, 13), (2019, 5), (2010, 1)], "anno int, mese int")
    got = {r.anno: (r.mesi, r.mesi_attesi, r.completezza) for r in CT.manifest_by_year(df).collect()}
    assert got[2026] == ("1,2,3", 6, 0.5)
    assert got[2020] == (",".join(str(i) for i in range(1, 13)), 12, 1.0)
    assert got[2019] == ("5", 12, 0.08)
    assert got[2010] == ("1", 0, 0.0)


def test_manifest_index_carries_old_years(spark):
    prev = spark.createDataFrame([(2019, 5), (2020, 6)], "anno int, righe bigint")
    cur = spark.createDataFrame([(2020, 7), (2021, 8)], "anno int, righe bigint")
    got = {(r.anno, r.righe, r.origine) for r in CT.manifest_index(cur, prev).collect()}
    assert got == {(2019, 5, "precedente"), (2020, 7, "corrente"), (2021, 8, "corrente")}


def test_column_catalog_and_entity_index(spark):
    clean = clean_aid(S.aid_raw(spark, SF_SMALL))
    meas = clean_measure(S.measure_raw(spark, SF_SMALL))
    cat = CT.column_catalog(spark, {"aiuti_stato": clean, "misure": meas})
    rows = {(r.dataset, r.colonna): r for r in cat.collect()}
    assert rows[("aiuti_stato", "elemento_aiuto")].ruolo == "metric"
    assert rows[("aiuti_stato", "cup")].tipo_semantico == "cup_code"
    assert rows[("misure", "anno")].tipo == "INTEGER"
    idx = {(r.dataset, r.colonna): r for r in CT.joinable_columns(cat).collect()}
    assert idx[("misure", "anno")].collegabile and idx[("misure", "anno")].entita == "Tempo"
    assert not idx[("aiuti_stato", "cup")].collegabile


def test_file_summary_totals(spark, tmp_dir):
    raw = S.aid_raw(spark, SF_SMALL)
    ST.write_year_overwrite(raw, tmp_dir)
    s = {r.anno: r for r in CT.file_summary(spark, tmp_dir).collect()}
    assert s[None].righe == raw.count()
    assert sum(r.righe for k, r in s.items() if k is not None) == s[None].righe
    assert s[None].mb >= 0


def test_manifest_measures_with_size(spark, tmp_dir):
    meas = clean_measure(S.measure_raw(spark, SF_SMALL))
    meas.write.parquet(tmp_dir + "/m")
    r = CT.manifest_measures(spark.read.parquet(tmp_dir + "/m"), ST.path_bytes(spark, tmp_dir + "/m")).first()
    assert (r.righe, r.campi) == (meas.count(), 20) and r.size_mb >= 0


def test_manifest_sizes_and_totals(spark, tmp_dir):
    from aidspark.operators import catalog as CT
    from aidspark.plans import storage as ST
    from aidspark.sources import standin as S
    raw = S.aid_raw(spark, "/root/testdata/sf0.001")
    ST.write_year_overwrite(raw, tmp_dir)
    files = CT.file_list(spark, tmp_dir).collect()
    assert sum(r.righe for r in files) == raw.count() and all(r.byte > 0 for r in files)
    sizes = CT.year_sizes(spark, tmp_dir)
    index = CT.manifest_index(CT.manifest_by_year(raw.where("anno >= 1998"), sizes=sizes),
                              CT.manifest_by_year(raw, sizes=sizes))
    assert index.where("size_mb IS NULL").count() == 0
    total = CT.index_totals(index).first()
    assert total.righe_totali == raw.count()
    assert abs(total.mb_totali - sum(r.size_mb for r in sizes.collect())) < 0.11


def test_no_verdict_is_a_failure_and_all_are_counted(spark):
    import pytest

    from aidspark.operators import quality as Q
    with pytest.raises(Q.QualityError, match="^30 failed"):
        Q.enforce(spark.createDataFrame([(False,)] * 30, "esito boolean"))
    with pytest.raises(Q.QualityError):
        Q.enforce(spark.createDataFrame([(None,)], "esito boolean"))
    empty = spark.createDataFrame([], "anno int")
    assert Q.dq_not_null(empty, ["anno"], "t").first().esito is True
