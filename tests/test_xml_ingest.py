"""XML source, repair and flatten (S1-S16) on hand-written records."""


from pyspark.sql import functions as F

from aidspark.operators.clean import conform_schema
from aidspark.operators.flatten import CORRUPT, OK, STATUS, YEAR_ZERO, flatten_aid, flatten_measure
from aidspark.schemas import AID_COLUMNS, AID_DEDUP_KEY, AID_SCHEMA, MEASURE_COLUMNS, MEASURE_SCHEMA
from aidspark.sources import xml as X
from tests.conftest import write_text

HEADER = '<?xml version="1.0" encoding="UTF-8"?>\n<LISTA_AIUTI xmlns="http://www.rna.it/RNA_aiuto/schema">\n'
FOOTER = "</LISTA_AIUTI>\n"

GRANT = """<AIUTO>
  <CAR>4411</CAR><COR>90001</COR>
  <TITOLO_MISURA>Bando  innovazione
     digitale</TITOLO_MISURA>
  <DES_TIPO_MISURA>Regime di aiuti</DES_TIPO_MISURA>
  <BASE_GIURIDICA_NAZIONALE>DL 34/2020</BASE_GIURIDICA_NAZIONALE>
  <SOGGETTO_CONCEDENTE>Regione Umbria</SOGGETTO_CONCEDENTE>
  <DATA_CONCESSIONE>2021-03-09</DATA_CONCESSIONE>
  <CUP>J11B21000010002</CUP>
  <DENOMINAZIONE_BENEFICIARIO>ALFA MECCANICA SRL</DENOMINAZIONE_BENEFICIARIO>
  <CODICE_FISCALE_BENEFICIARIO>09876543210</CODICE_FISCALE_BENEFICIARIO>
  <DES_TIPO_BENEFICIARIO>PMI</DES_TIPO_BENEFICIARIO>
  <REGIONE_BENEFICIARIO>Umbria</REGIONE_BENEFICIARIO>
  <COMPONENTI_AIUTO>
    <COMPONENTE_AIUTO>
      <ID_COMPONENTE_AIUTO>71</ID_COMPONENTE_AIUTO>
      <COD_PROCEDIMENTO>3</COD_PROCEDIMENTO><DES_PROCEDIMENTO>Esenzione</DES_PROCEDIMENTO>
      <COD_OBIETTIVO>50</COD_OBIETTIVO><DES_OBIETTIVO>Innovazione</DES_OBIETTIVO>
      <SETTORE_ATTIVITA>(NACE 2) C.25.6</SETTORE_ATTIVITA>
      <STRUMENTI_AIUTO>
        <STRUMENTO_AIUTO><COD_STRUMENTO>1</COD_STRUMENTO><DES_STRUMENTO>Sovvenzione</DES_STRUMENTO>
          <ELEMENTO_DI_AIUTO>1500,50</ELEMENTO_DI_AIUTO><IMPORTO_NOMINALE>1500.50</IMPORTO_NOMINALE></STRUMENTO_AIUTO>
        <STRUMENTO_AIUTO><COD_STRUMENTO>4</COD_STRUMENTO><DES_STRUMENTO>Garanzia</DES_STRUMENTO>
          <ELEMENTO_DI_AIUTO>320</ELEMENTO_DI_AIUTO><IMPORTO_NOMINALE>8000</IMPORTO_NOMINALE></STRUMENTO_AIUTO>
      </STRUMENTI_AIUTO>
    </COMPONENTE_AIUTO>
  </COMPONENTI_AIUTO>
</AIUTO>
"""

BARE = """<AIUTO><COR>90002</COR><DATA_CONCESSIONE>2022</DATA_CONCESSIONE>
  <DENOMINAZIONE_BENEFICIARIO>BETA SPA</DENOMINAZIONE_BENEFICIARIO></AIUTO>
"""


def _ingest(spark, path):
    return flatten_aid(X.read_aid_xml(spark, path))


def _rows(df, order="cod_strumento"):
    return [r.asDict() for r in df.orderBy(order).collect()]


def test_grant_fields_and_two_instruments(spark, tmp_dir):
    write_text(tmp_dir, "OpenData_Aiuti_2021_03.xml", HEADER + GRANT + FOOTER)
    rows = _rows(_ingest(spark, tmp_dir).where(F.col(STATUS) == OK))
    assert len(rows) == 2
    a, b = rows
    assert a["cor"] == "90001" and a["car"] == "4411"
    assert a["titolo_misura"] == "Bando innovazione digitale"
    assert a["regione_beneficiario"] == "Umbria" and a["tipo_beneficiario"] == "PMI"
    assert a["id_componente"] == "71" and a["procedimento"] == "Esenzione"
    assert a["settore_attivita"] == "(NACE 2) C.25.6"
    assert (a["cod_strumento"], a["strumento"], a["elemento_aiuto"], a["importo_nominale"]) == \
        ("1", "Sovvenzione", 1500.5, 1500.5)
    assert (b["cod_strumento"], b["elemento_aiuto"], b["importo_nominale"]) == ("4", 320.0, 8000.0)
    assert (a["anno"], a["mese"]) == (2021, 3)
    assert a["titolo_progetto"] == "" and a["atto_concessione"] == ""


def test_grant_without_components_gives_one_row(spark, tmp_dir):
    write_text(tmp_dir, "f.xml", HEADER + BARE + FOOTER)
    rows = _rows(_ingest(spark, tmp_dir))
    assert len(rows) == 1
    r = rows[0]
    assert r["cor"] == "90002" and r["denominazione_beneficiario"] == "BETA SPA"
    assert r["id_componente"] == "" and r["cod_strumento"] == "" and r["settore_attivita"] == ""
    assert r["elemento_aiuto"] is None and r["importo_nominale"] is None
    assert (r["anno"], r["mese"]) == (2022, 0)


def test_component_without_instruments_and_empty_container(spark, tmp_dir):
    rec = ("<AIUTO><COR>1</COR><DATA_CONCESSIONE>2020-01-02</DATA_CONCESSIONE><COMPONENTI_AIUTO/>"
           "<COMPONENTI_AIUTO><COMPONENTE_AIUTO><ID_COMPONENTE_AIUTO>9</ID_COMPONENTE_AIUTO>"
           "</COMPONENTE_AIUTO></COMPONENTI_AIUTO></AIUTO>\n")
    write_text(tmp_dir, "f.xml", HEADER + rec + FOOTER)
    rows = _rows(_ingest(spark, tmp_dir))
    assert len(rows) == 1
    assert rows[0]["id_componente"] == "9" and rows[0]["cod_strumento"] == ""
    assert rows[0]["elemento_aiuto"] is None


def test_all_31_columns_and_schema(spark, tmp_dir):
    write_text(tmp_dir, "f.xml", HEADER + GRANT + FOOTER)
    out = conform_schema(_ingest(spark, tmp_dir), AID_SCHEMA)
    assert out.columns == AID_COLUMNS
    assert len(AID_SCHEMA) == 31 and len(MEASURE_SCHEMA) == 20
    assert all(k in AID_COLUMNS for k in AID_DEDUP_KEY)


def test_repair_chain_before_parse(spark, tmp_dir):
    damaged = (b"<AIUTO><COR>5\x01</COR><DATA_CONCESSIONE>2019-11-30</DATA_CONCESSIONE>"
               b"<BASE_GIURIDICA_NAZ>Legge 1/2019</BASE_GIURIDICA_NAZ>"
               b"<TITOLO_PROGETTO>R&D e &#1;prototipi</TITOLO_PROGETTO>"
               b"<COMPONENTI_AIUTO><COMPONENTE_AIUTO><STRUMENTI_AIUTO><STRUMENTO_AIUTO>"
               b"<COD_STRUMENTO>2</COD_STRUMENTO><IMPORTO_NOMIN>12,5</IMPORTO_NOMIN>"
               b"</STRUMENTO_AIUTO></STRUMENTI_AIUTO></COMPONENTE_AIUTO></COMPONENTI_AIUTO></AIUTO>\n")
    write_text(tmp_dir, "f.xml", HEADER.encode() + damaged + FOOTER.encode())
    r = _rows(_ingest(spark, tmp_dir))[0]
    assert r["cor"] == "5"
    assert r["base_giuridica_nazionale"] == "Legge 1/2019"
    assert r["titolo_progetto"] == "R&D e prototipi"
    assert r["importo_nominale"] == 12.5
    assert (r["anno"], r["mese"]) == (2019, 11)


def test_source_parser_rules(spark, tmp_dir):
    """First occurrence of a repeated tag wins; attributes, prefixes, CDATA."""
    rec = ('<AIUTO id="x"><COR>7</COR><CUP>first</CUP><CUP>second</CUP>'
           '<n:SOGGETTO_CONCEDENTE>Comune</n:SOGGETTO_CONCEDENTE>'
           '<TITOLO_MISURA><![CDATA[a < b]]></TITOLO_MISURA>'
           '<DATA_CONCESSIONE>2018-07-01</DATA_CONCESSIONE></AIUTO>\n')
    write_text(tmp_dir, "f.xml", HEADER + rec + FOOTER)
    r = _rows(_ingest(spark, tmp_dir))[0]
    assert r["cup"] == "first" and r["soggetto_concedente"] == "Comune" and r["titolo_misura"] == "a < b"


def test_malformed_record_is_quarantined_not_fatal(spark, tmp_dir):
    bad = "<AIUTO><COR>8</COR><TITOLO_PROGETTO>unclosed</AIUTO>\n"
    write_text(tmp_dir, "f.xml", HEADER + GRANT + bad + BARE + FOOTER)
    flat = _ingest(spark, tmp_dir)
    statuses = {r[STATUS]: r["n"] for r in flat.groupBy(STATUS).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert statuses == {OK: 3, CORRUPT: 1}
    counts = X.parse_counts(X.read_aid_xml(spark, tmp_dir)).first()
    assert (counts.record_ok, counts.record_scartati) == (2, 1)


def test_year_zero_status(spark, tmp_dir):
    rec = "<AIUTO><COR>3</COR><DATA_CONCESSIONE>n.d.</DATA_CONCESSIONE></AIUTO>\n"
    write_text(tmp_dir, "f.xml", HEADER + rec + FOOTER)
    r = _rows(_ingest(spark, tmp_dir))[0]
    assert r[STATUS] == YEAR_ZERO and (r["anno"], r["mese"]) == (0, 0)


def test_splittable_many_records_keep_order(spark, tmp_dir):
    recs = "".join(
        f"<AIUTO><COR>{i}</COR><DATA_CONCESSIONE>2020-01-01</DATA_CONCESSIONE>"
        f"<COMPONENTI_AIUTO><COMPONENTE_AIUTO><ID_COMPONENTE_AIUTO>1</ID_COMPONENTE_AIUTO>"
        f"</COMPONENTE_AIUTO></COMPONENTI_AIUTO></AIUTO>\n" for i in range(3000))
    write_text(tmp_dir, "big.xml", HEADER + recs + FOOTER)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        flat = _ingest(spark, tmp_dir)
        assert X.record_text(spark, tmp_dir, "AIUTO").rdd.getNumPartitions() > 5
        got = [int(r.cor) for r in flat.where(F.col(STATUS) == OK).orderBy("_arrival").select("cor").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(range(3000))


def test_select_files_by_year_and_glob(spark, tmp_dir):
    write_text(tmp_dir, "OpenData_Aiuti_2020_05.xml", HEADER + GRANT + FOOTER)
    write_text(tmp_dir, "OpenData_Aiuti_2023_01.xml", HEADER + BARE + FOOTER)
    write_text(tmp_dir, "other.txt", HEADER + BARE + FOOTER)
    all_files = X.read_aid_xml(spark, tmp_dir, glob=X.AID_FILE_GLOB).count()
    only_2020 = X.read_aid_xml(spark, tmp_dir, glob=X.AID_FILE_GLOB, years=(2019, 2021)).count()
    assert (all_files, only_2020) == (2, 1)


MEASURE = """<?xml version="1.0"?>
<ns2:LISTA_MISURE_TYPE xmlns="http://www.rna.it/RNA_misura/schema" xmlns:ns2="x">
<MISURA>
  <CAR>3301</CAR><CAR_PADRE>3300</CAR_PADRE><CAR_ATTIVO>3305</CAR_ATTIVO>
  <TITOLO_MISURA>Fondo crescita</TITOLO_MISURA><COD_TIPO_MISURA>2</COD_TIPO_MISURA>
  <DES_TIPO_MISURA>Aiuto ad hoc</DES_TIPO_MISURA>
  <DATA_INIZIO_MISURA>2015-04-01T00:00:00.000+02:00</DATA_INIZIO_MISURA>
  <DATA_FINE_MISURA>9999-12-31T00:00:00.000+01:00</DATA_FINE_MISURA>
  <AUTORITA_CONCEDENTE_TRASP_CE>Ministero</AUTORITA_CONCEDENTE_TRASP_CE>
  <FLAG_MODIFICA_REGIME_O_ESISTENTE>SI</FLAG_MODIFICA_REGIME_O_ESISTENTE>
  <IMPORTO_PRESTITI_GARANTITI>10,25</IMPORTO_PRESTITI_GARANTITI>
  <IMPORTO_AIUTO_AD_HOC>500</IMPORTO_AIUTO_AD_HOC>
</MISURA>
<MISURA></MISURA>
</ns2:LISTA_MISURE_TYPE>
"""


def test_measure_full_and_empty(spark, tmp_dir):
    write_text(tmp_dir, "m.xml", MEASURE)
    rows = [r.asDict() for r in flatten_measure(X.read_measure_xml(spark, tmp_dir)).collect()]
    full = [r for r in rows if r["car"] == "3301"][0]
    empty = [r for r in rows if r["car"] == ""][0]
    assert full["autorita_concedente"] == "Ministero" and full["flag_modifica_regime"] == "SI"
    assert full["importo_prestiti_garantiti"] == 10.25 and full["importo_aiuto_ad_hoc"] == 500.0
    assert (full["anno"], full["mese"]) == (2015, 4) and full[STATUS] == OK
    assert empty["titolo_misura"] == "" and empty["importo_prestiti_garantiti"] is None
    assert empty["anno"] == 0 and empty[STATUS] == YEAR_ZERO
    assert [c for c in rows[0] if c in MEASURE_COLUMNS] == MEASURE_COLUMNS


def test_unreadable_file_is_skipped(spark, tmp_dir):
    import gzip
    write_text(tmp_dir, "OpenData_Aiuti_2021_03.xml", HEADER + GRANT + FOOTER)
    good = gzip.compress((HEADER + BARE + FOOTER).encode())
    write_text(tmp_dir, "OpenData_Aiuti_2021_04.xml.gz", good[: len(good) // 2])  # truncated archive
    counts = {r.fonte.rsplit("/", 1)[-1]: (r.record_ok, r.record_scartati)
              for r in X.parse_counts(X.read_aid_xml(spark, tmp_dir, skip_bad_files=True)).collect()}
    assert counts["OpenData_Aiuti_2021_03.xml"] == (1, 0)
    report = {r.fonte.rsplit("/", 1)[-1]: (r.record_ok, r.letto)
              for r in X.file_report(spark, tmp_dir, X.read_aid_xml(spark, tmp_dir, skip_bad_files=True)).collect()}
    assert report == {"OpenData_Aiuti_2021_03.xml": (1, True), "OpenData_Aiuti_2021_04.xml.gz": (0, False)}


def _statuses(spark, path):
    return sorted((r[STATUS], r.cor or "") for r in _ingest(spark, path).select(STATUS, "cor").collect())


def test_unclosed_record_does_not_take_its_neighbour(spark, tmp_dir):
    open_ended = BARE.replace("</AIUTO>", "").replace("90002", "1")
    write_text(tmp_dir, "OpenData_Aiuti_2022_01.xml",
               HEADER + open_ended + BARE.replace("90002", "2") + BARE.replace("90002", "3") + FOOTER)
    got = _statuses(spark, tmp_dir)
    assert [g for g in got if g[0] == OK] == [(OK, "2"), (OK, "3")]
    assert len([g for g in got if g[0] == CORRUPT]) == 1


def test_prefixed_record_tags_are_all_read(spark, tmp_dir):
    records = "".join(BARE.replace("90002", str(i)).replace("<AIUTO>", "<n:AIUTO>").replace("</AIUTO>", "</n:AIUTO>")
                      for i in (1, 2, 3))
    write_text(tmp_dir, "OpenData_Aiuti_2022_01.xml", HEADER + records + FOOTER)
    assert _statuses(spark, tmp_dir) == [(OK, "1"), (OK, "2"), (OK, "3")]


def test_file_year_comes_from_the_file_name(spark, tmp_dir):
    write_text(f"{tmp_dir}/dump_2019_01", "OpenData_Aiuti_2023_05.xml", HEADER + BARE + FOOTER)
    read = lambda y: X.read_aid_xml(spark, tmp_dir, years=(y, y)).count()
    assert read(2019) == 0 and read(2023) == 1


def test_broken_file_stops_a_rebuild_before_the_table_changes(spark, tmp_dir):
    import gzip

    import pytest

    from aidspark.plans import storage as ST
    src, table = f"{tmp_dir}/in", f"{tmp_dir}/table"
    write_text(src, "OpenData_Aiuti_2022_01.xml", HEADER + BARE + FOOTER)
    ST.rebuild_years(spark, src, table, 2022, 2022)
    body = HEADER + "".join(BARE.replace("90002", str(i)) for i in range(2000)) + FOOTER
    packed = gzip.compress(body.encode())
    write_text(src, "OpenData_Aiuti_2022_02.xml.gz", packed[:len(packed) * 2 // 3])
    before = [tuple(r) for r in ST.read_all_years(spark, table).collect()]
    with pytest.raises(Exception):
        ST.rebuild_years(spark, src, table, 2022, 2022)
    assert [tuple(r) for r in ST.read_all_years(spark, table).collect()] == before
    out = ST.rebuild_years(spark, src, table, 2022, 2022, allow_failed=True)
    assert {r.fonte.rsplit("/", 1)[1]: r.letto for r in out.files.collect()} == {
        "OpenData_Aiuti_2022_01.xml": True, "OpenData_Aiuti_2022_02.xml.gz": False}
    assert [r.cor for r in ST.read_all_years(spark, table).collect()] == ["90002"]  # nothing of half a file
