"""Keep-last dedup and yearly writes."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from aidspark.operators.dedup import dedup_keep_last
from aidspark.plans import storage as ST
from aidspark.schemas import AID_COLUMNS, AID_DEDUP_KEY, AID_SCHEMA


def _rows(spark, specs):
    """specs: (cor, comp, strum, anno, seq, soggetto)."""
    base = {c: "" for c in AID_COLUMNS}
    out = []
    for cor, comp, strum, anno, seq, who in specs:
        r = dict(base, cor=cor, id_componente=comp, cod_strumento=strum, soggetto_concedente=who,
                 elemento_aiuto=1.0, importo_nominale=1.0, anno=anno, mese=1)
        out.append(tuple(r[c] for c in AID_COLUMNS) + (seq,))
    schema = StructType(AID_SCHEMA.fields + [StructField("_arrival", LongType())])
    return spark.createDataFrame(out, schema)


def test_dedup_keeps_last_and_empty_keys_take_part(spark):
    df = _rows(spark, [("1", "a", "x", 2020, 1, "first"), ("1", "a", "x", 2020, 3, "last"),
                       ("1", "a", "x", 2020, 2, "middle"), ("", "", "", 2020, 5, "e1"),
                       ("", "", "", 2020, 4, "e0"), ("2", "a", "x", 2020, 1, "only")])
    got = {(r.cor, r.soggetto_concedente) for r in dedup_keep_last(df, AID_DEDUP_KEY, "_arrival").collect()}
    assert got == {("1", "last"), ("", "e1"), ("2", "only")}


def test_overwrite_replaces_only_requested_years(spark, tmp_dir):
    first = _rows(spark, [("1", "a", "x", 2021, 1, "v1"), ("2", "a", "x", 2022, 1, "v1")])
    ST.write_year_overwrite(first, tmp_dir)
    second = _rows(spark, [("3", "a", "x", 2022, 1, "v2"), ("4", "a", "x", 2023, 1, "stray")])
    strays = ST.write_year_overwrite(second, tmp_dir, years=[2022])
    got = {(r.anno, r.cor, r.soggetto_concedente) for r in ST.read_all_years(spark, tmp_dir).collect()}
    assert got == {(2021, "1", "v1"), (2022, "3", "v2")}
    assert [r.cor for r in strays.collect()] == ["4"]


def test_overwrite_with_dedup(spark, tmp_dir):
    df = _rows(spark, [("1", "a", "x", 2021, 1, "old"), ("1", "a", "x", 2021, 2, "new")])
    ST.write_year_overwrite(df, tmp_dir, dedup=True)
    assert [r.soggetto_concedente for r in ST.read_year(spark, tmp_dir, 2021).collect()] == ["new"]


def test_append_merges_and_new_rows_win(spark, tmp_dir):
    ST.write_year_overwrite(_rows(spark, [("1", "a", "x", 2021, 1, "old"), ("2", "a", "x", 2021, 1, "keep"),
                                          ("9", "a", "x", 2020, 1, "untouched")]), tmp_dir)
    ST.upsert_append(spark, _rows(spark, [("1", "a", "x", 2021, 7, "new"), ("3", "a", "x", 2021, 8, "added")]),
                     tmp_dir)
    got = {(r.anno, r.cor, r.soggetto_concedente) for r in ST.read_all_years(spark, tmp_dir).collect()}
    assert got == {(2021, "1", "new"), (2021, "2", "keep"), (2021, "3", "added"), (2020, "9", "untouched")}


def test_append_into_empty_location(spark, tmp_dir):
    target = tmp_dir + "/fresh"
    ST.upsert_append(spark, _rows(spark, [("1", "a", "x", 2021, 1, "a"), ("1", "a", "x", 2021, 2, "b")]), target)
    assert [r.soggetto_concedente for r in spark.read.parquet(target).collect()] == ["b"]


def test_unknown_mode_is_rejected(spark, tmp_dir):
    with pytest.raises(ValueError):
        ST.upsert_append(spark, _rows(spark, [("1", "a", "x", 2021, 1, "a")]), tmp_dir, mode="merge")


def test_read_all_years_unites_by_name(spark, tmp_dir):
    a = _rows(spark, [("1", "a", "x", 2020, 1, "a")]).drop("_arrival")
    b = _rows(spark, [("2", "a", "x", 2021, 1, "b")]).drop("_arrival").withColumn("fonte", F.lit("z"))
    ST._write_years(a, tmp_dir)
    ST._write_years(b, tmp_dir)
    got = {(r.cor, r.fonte) for r in ST.read_all_years(spark, tmp_dir).collect()}
    assert got == {("1", None), ("2", "z")}


def test_layer_run_per_year_and_report(spark, tmp_dir):
    from aidspark.plans import layers as L
    from aidspark.sources import standin as S
    from tests.conftest import SF_SMALL
    raw_path = tmp_dir + "/raw"
    ST.write_year_overwrite(S.aid_raw(spark, SF_SMALL), raw_path)
    raw = spark.read.parquet(raw_path)
    year = raw.agg(F.min("anno")).first()[0]
    rep = L.run_aid(spark, raw, tmp_dir + "/out", year=year)
    clean = spark.read.parquet(rep["clean_path"])
    assert rep["clean_path"].endswith(f"/{year}/clean")
    assert rep["clean_rows"] == clean.count() == raw.where((F.col("anno") == year)
                                                          & F.col("elemento_aiuto").isNotNull()).count()
    assert set(rep["marts"]) == set(L.AID_REGISTERED)
    assert rep["output_bytes"]["clean"] > 0 and rep["output_bytes"]["mart"] > 0
    sig = {r.layer: r for r in L.signal(spark, rep, "aiuti_stato", year).collect()}
    assert sig["clean"].righe == rep["clean_rows"] and sig["mart"].righe == rep["mart_rows"]
    assert sig["clean"].stato == "WARNING" and sig["clean"].punteggio_qualita == 80  # min_rows fails at this size
    m = L.run_measures(spark, S.measure_raw(spark, SF_SMALL), tmp_dir + "/m", fail_on_error=False)
    assert m["clean_gates_failed"] == ["min_rows"]
    import pytest
    from aidspark.operators.quality import QualityError
    with pytest.raises(QualityError):
        L.run_measures(spark, S.measure_raw(spark, SF_SMALL), tmp_dir + "/m2", fail_on_error=True)


def test_rebuild_does_not_overwrite_unrequested_years(spark, tmp_dir):
    from tests.conftest import write_text
    from tests.test_xml_ingest import FOOTER, HEADER
    base = tmp_dir + "/table"
    ST.write_year_overwrite(_rows(spark, [("old22", "a", "x", 2022, 1, "keep"),
                                          ("old23", "a", "x", 2023, 1, "replace")]), base)
    rec = ("<AIUTO><COR>{c}</COR><DATA_CONCESSIONE>{d}</DATA_CONCESSIONE><COMPONENTI_AIUTO><COMPONENTE_AIUTO>"
           "<ID_COMPONENTE_AIUTO>1</ID_COMPONENTE_AIUTO></COMPONENTE_AIUTO></COMPONENTI_AIUTO></AIUTO>\n")
    write_text(tmp_dir + "/xml", "OpenData_Aiuti_2023_05.xml",
               HEADER + rec.format(c="new23", d="2023-05-02") + rec.format(c="stray22", d="2022-12-30") + FOOTER)
    write_text(tmp_dir + "/xml", "OpenData_Aiuti_2021_01.xml", HEADER + rec.format(c="skip21", d="2021-01-02") + FOOTER)
    out = ST.rebuild_years(spark, tmp_dir + "/xml", base, 2023, 2023)
    got = {(r.anno, r.cor) for r in ST.read_all_years(spark, base).collect()}
    assert got == {(2022, "old22"), (2023, "new23")}
    assert [r.cor for r in ST.strays(spark, out, 2023, 2023).collect()] == ["stray22"]


def test_append_without_arrival_column(spark, tmp_dir):
    rows = _rows(spark, [("1", "a", "x", 2021, 1, "first"), ("1", "a", "x", 2021, 2, "second")]).drop("_arrival")
    ST.upsert_append(spark, rows.coalesce(1), tmp_dir + "/t")
    assert [r.soggetto_concedente for r in spark.read.parquet(tmp_dir + "/t").collect()] == ["second"]


def test_dedup_is_per_year_partition(spark, tmp_dir):
    df = _rows(spark, [("1", "a", "x", 2021, 1, "y21"), ("1", "a", "x", 2022, 2, "y22"),
                       ("1", "a", "x", 2022, 3, "y22b")])
    ST.write_year_overwrite(df, tmp_dir, dedup=True)
    got = {(r.anno, r.soggetto_concedente) for r in ST.read_all_years(spark, tmp_dir).collect()}
    assert got == {(2021, "y21"), (2022, "y22b")}


def test_requested_year_without_rows_is_cleared(spark, tmp_dir):
    ST.write_year_overwrite(_rows(spark, [("1", "a", "x", 2021, 1, "v1"), ("2", "a", "x", 2022, 1, "v1"),
                                          ("3", "a", "x", 2023, 1, "v1")]), tmp_dir)
    ST.write_year_overwrite(_rows(spark, [("4", "a", "x", 2022, 1, "v2")]), tmp_dir, years=[2021, 2022])
    assert {(r.anno, r.cor) for r in ST.read_all_years(spark, tmp_dir).collect()} == {(2022, "4"), (2023, "3")}


def test_duplicates_already_stored_keep_the_last_to_arrive(spark, tmp_dir):
    old = [(str(k), "a", "x", 2021, 100 * f + k, f"file{f}") for f in range(4) for k in range(40)]
    ST.write_year_overwrite(_rows(spark, old).repartition(7), tmp_dir)  # no dedup
    ST.upsert_append(spark, _rows(spark, [("0", "a", "x", 2021, 1, "new")]), tmp_dir)
    got = {r.cor: r.soggetto_concedente for r in ST.read_all_years(spark, tmp_dir).collect()}
    assert got == {str(k): "new" if k == 0 else "file3" for k in range(40)}
    assert set(ST.read_all_years(spark, tmp_dir).columns) == set(AID_COLUMNS)


def test_upsert_prunes_to_the_years_of_the_batch(spark, tmp_dir, monkeypatch):
    ST.write_year_overwrite(_rows(spark, [(str(y), "a", "x", y, 1, "v") for y in range(2015, 2025)]), tmp_dir)
    seen = []
    real = ST.dedup_keep_last
    monkeypatch.setattr(ST, "dedup_keep_last", lambda df, *a, **k: seen.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(df, *a, **k))
    ST.upsert_append(spark, _rows(spark, [("1", "a", "x", 2021, 1, "n")]), tmp_dir)
    plan = next(line for line in seen[0].splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters" in plan and "2021" in plan and "2020" not in plan


def test_interrupted_swap_is_finished_by_the_next_upsert(spark, tmp_dir):
    ST.write_year_overwrite(_rows(spark, [("1", "a", "x", 2021, 1, "old"), ("2", "a", "x", 2022, 1, "old")]), tmp_dir)
    # a complete copy that a dead job left, and an upsert of another year
    merged = ST._table_rows(_rows(spark, [("1", "a", "x", 2021, 2, "merged")]))
    merged.write.partitionBy("anno").parquet(ST._swap_path(tmp_dir))
    ST.upsert_append(spark, _rows(spark, [("2", "a", "x", 2022, 3, "new")]), tmp_dir)
    got = {(r.cor, r.soggetto_concedente) for r in ST.read_all_years(spark, tmp_dir).collect()}
    assert got == {("1", "merged"), ("2", "new")}
    assert not ST.path_exists(spark, ST._swap_path(tmp_dir))


def test_staging_folder_can_be_used_again(spark, tmp_dir):
    from aidspark.operators.flatten import OK, STATUS
    for cor, year in (("1", 2021), ("2", 2022)):
        rows = _rows(spark, [(cor, "a", "x", year, 1, "v")]).withColumn(STATUS, F.lit(OK))
        ST.stage_xml(rows, tmp_dir)
    assert [r.cor for r in ST.staged(spark, tmp_dir, OK).collect()] == ["2"]
