"""Malformed records keep their readable fields (S15); prefixed files are split (S1, S2);
unreadable files are found by one job (S15)."""

import gzip

import pytest
from pyspark.sql import functions as F

from aidspark.functions.salvage import salvage_xml
from aidspark.operators.flatten import CORRUPT, OK, STATUS, flatten_aid, flatten_measure
from aidspark.schemas import AID_XML_SCHEMA, MEASURE_XML_SCHEMA
from aidspark.sources import xml as X
from tests.conftest import write_text
from tests.test_xml_ingest import FOOTER, GRANT, HEADER

INSTRUMENT = "<STRUMENTO_AIUTO><COD_STRUMENTO>{}</COD_STRUMENTO><ELEMENTO_DI_AIUTO>5</ELEMENTO_DI_AIUTO></STRUMENTO_AIUTO>"
RECORD = ("<AIUTO><COR>1</COR><CUP>c</CUP><TITOLO_PROGETTO>t</TITOLO_PROGETTO><DATA_CONCESSIONE>2021-03-04</DATA_CONCESSIONE>"
          "<COMPONENTI_AIUTO><COMPONENTE_AIUTO><ID_COMPONENTE_AIUTO>a</ID_COMPONENTE_AIUTO><STRUMENTI_AIUTO>"
          + INSTRUMENT.format("1") + INSTRUMENT.format("2") + "</STRUMENTI_AIUTO></COMPONENTE_AIUTO>"
          "<COMPONENTE_AIUTO><ID_COMPONENTE_AIUTO>b</ID_COMPONENTE_AIUTO></COMPONENTE_AIUTO></COMPONENTI_AIUTO></AIUTO>")
WHOLE = {("1", "c", "t", "a", "1", 5.0), ("1", "c", "t", "a", "2", 5.0), ("1", "c", "t", "b", "", None)}


def ingest(spark, path, text, salvage=True):
    write_text(path, "f.xml", HEADER + text + FOOTER)
    rows = flatten_aid(X.read_aid_xml(spark, path, salvage=salvage)).collect()
    good = {(r.cor, r.cup, r.titolo_progetto, r.id_componente, r.cod_strumento, r.elemento_aiuto) for r in rows if r[STATUS] == OK}
    return good, [r._corrupt_record for r in rows if r[STATUS] == CORRUPT]


def without(text, part, nth=1):
    at = -1
    for _ in range(nth):
        at = text.index(part, at + 1)
    return text[:at] + text[at + len(part):]


DAMAGE = {
    "unclosed leaf": without(RECORD, "</CUP>"),
    "unclosed leaf at the end of its element": without(RECORD, "</ELEMENTO_DI_AIUTO>"),
    "leaf that never opened": without(RECORD, "<TITOLO_PROGETTO>").replace(">t</TITOLO_PROGETTO>", "></TITOLO_PROGETTO>"),
    "unclosed instrument": without(RECORD, "</STRUMENTO_AIUTO>"),
    "unclosed last instrument": without(RECORD, "</STRUMENTO_AIUTO>", 2),
    "unclosed list": without(RECORD, "</STRUMENTI_AIUTO>"),
    "unclosed component": without(RECORD, "</COMPONENTE_AIUTO>"),
    "unclosed components": without(RECORD, "</COMPONENTI_AIUTO>"),
    "everything behind a leaf is cut off": None,
    "stray closing tags": RECORD.replace("<CUP>", "</NOTE></STRUMENTO_AIUTO><CUP>"),
    "unknown element that stays open": RECORD.replace("</COMPONENTI_AIUTO>", "</COMPONENTI_AIUTO><NOTE>x"),
    "broken attributes": RECORD.replace("<CUP>", "<CUP a= b>").replace("<COMPONENTE_AIUTO>", "<COMPONENTE_AIUTO id=3>", 1),
    "crossed tags": RECORD.replace("</STRUMENTI_AIUTO></COMPONENTE_AIUTO>", "</COMPONENTE_AIUTO></STRUMENTI_AIUTO>"),
    "comment and section": RECORD.replace("<CUP>", "<!-- <x> --></Y><CUP>").replace(">t<", "><![CDATA[t]]><"),
}


@pytest.mark.parametrize("name", DAMAGE)
def test_a_damaged_record_keeps_its_fields(spark, tmp_dir, name):
    text, want = DAMAGE[name], WHOLE
    if name == "leaf that never opened":
        want = {(a, b, "", d, e, f) for a, b, _, d, e, f in WHOLE}
    if text is None:
        text = RECORD[:RECORD.index("<COMPONENTI_AIUTO>")] + "</AIUTO>"
        text, want = without(text, "</DATA_CONCESSIONE>"), {("1", "c", "t", "", "", None)}
    good, bad = ingest(spark, tmp_dir, GRANT + text + "\n" + RECORD.replace(">1</COR>", ">9</COR>"))
    assert {r for r in good if r[0] == "1"} == want
    assert {r[0] for r in good} == {"1", "9", "90001"} and not bad
    plain, lost = ingest(spark, tmp_dir + "/plain", text, salvage=False)
    assert len(lost) == 1 and not plain


def test_a_lone_less_than_sign_is_text(spark, tmp_dir):
    good, bad = ingest(spark, tmp_dir, RECORD.replace(">t<", ">1 < 2 <<"))
    assert {r[2] for r in good} == {"1 < 2 <"} and not bad


def test_what_cannot_be_salvaged_is_quarantined(spark, tmp_dir):
    text = RECORD.replace(">c<", ">&#xFFFFFF;<")  # no character
    good, bad = ingest(spark, tmp_dir, text + RECORD.replace(">1</COR>", ">9</COR>"))
    assert {r[0] for r in good} == {"9"} and len(bad) == 1 and "&#xFFFFFF;" in bad[0]


def test_sound_records_are_not_changed(spark):
    texts = [RECORD, GRANT.strip(), "<AIUTO/>", "<AIUTO a='1'><CUP/><COR b = \"x\">1</COR></AIUTO>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", salvage_xml(F.col("t"), "AIUTO", AID_XML_SCHEMA).alias("s")).collect()
    assert all(r.t == r.s for r in got)


def test_salvaged_records_are_counted(spark, tmp_dir):
    write_text(tmp_dir, "f.xml", HEADER + RECORD + DAMAGE["unclosed leaf"] + RECORD.replace(">c<", ">&#xFFFFFF;<") + FOOTER)
    got = X.parse_counts(X.read_aid_xml(spark, tmp_dir, salvage=True)).first()
    assert (got.record_ok, got.record_scartati, got.record_recuperati) == (2, 1, 1)


def test_measures_are_salvaged(spark, tmp_dir):
    write_text(tmp_dir, "m.xml", "<L><MISURA><CAR>7<TITOLO_MISURA>x</TITOLO_MISURA><DATA_INIZIO_MISURA>2020-01-01</DATA_INIZIO_MISURA></MISURA></L>")
    row = flatten_measure(X.read_measure_xml(spark, tmp_dir, salvage=True)).first()
    assert (row.car, row.titolo_misura, row.anno) == ("7", "x", 2020)
    assert MEASURE_XML_SCHEMA is not None


def test_prefixed_files_are_split(spark, tmp_dir):
    record = "<n:AIUTO><n:COR>{}</n:COR><n:DATA_CONCESSIONE>2021-01-01</n:DATA_CONCESSIONE><CUP>{}</CUP></n:AIUTO>\n"
    write_text(tmp_dir, "OpenData_Aiuti_2021_01.xml", "<n:LISTA xmlns:n='u'>\n" + "".join(record.format(i, "x" * 900) for i in range(400)) + "</n:LISTA>")
    write_text(tmp_dir, "OpenData_Aiuti_2021_02.xml", HEADER + "".join(record.format(i, "y").replace("n:", "") for i in range(400, 500)) + FOOTER)
    write_text(tmp_dir, "OpenData_Aiuti_2021_03.xml", "<m:LISTA xmlns:m='u'>" + "".join(record.format(i, "z").replace("n:", "m:") for i in range(500, 550)) + "</m:LISTA>")
    with gzip.open(f"{tmp_dir.removeprefix('file:')}/OpenData_Aiuti_2021_04.xml.gz", "wt") as f:
        f.write("<k:LISTA xmlns:k='u'>" + "".join(record.format(i, "w").replace("n:", "k:") for i in range(550, 600)) + "</k:LISTA>")
    files = X.close_tags(spark, spark.read.text(tmp_dir).inputFiles(), "AIUTO")
    assert sorted(files.values()) == ["</AIUTO>", "</k:AIUTO>", "</m:AIUTO>", "</n:AIUTO>"]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        parsed = X.read_aid_xml(spark, tmp_dir)
        rows = flatten_aid(parsed).select("cor", "cup", STATUS, "_file", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted(int(r.cor) for r in rows if r[STATUS] == OK) == list(range(600))
    large = [r for r in rows if r._file.endswith("2021_01.xml") and r[STATUS] == OK]
    assert len(large) == 400 and len({r.task for r in large}) >= 5


def test_unreadable_files_are_found_among_others(spark, tmp_dir):
    root = tmp_dir.removeprefix("file:")
    for i in range(5):
        write_text(tmp_dir, f"OpenData_Aiuti_2021_0{i + 1}.xml", HEADER + RECORD.replace(">1</COR>", f">{i}</COR>") + FOOTER)
    data = gzip.compress((HEADER + RECORD * 300 + FOOTER).encode())
    for i in (6, 7):
        write_text(tmp_dir, f"OpenData_Aiuti_2021_0{i}.xml.gz", data[:len(data) // 2])
    found = {r.fonte.rsplit("/", 1)[1]: r.letto for r in X.readable_files(spark, tmp_dir).collect()}
    assert {n for n, ok in found.items() if not ok} == {"OpenData_Aiuti_2021_06.xml.gz", "OpenData_Aiuti_2021_07.xml.gz"}
    assert len(found) == 7
    rows = flatten_aid(X.read_aid_xml(spark, root, skip_bad_files=True)).where(F.col(STATUS) == OK)
    assert rows.select("cor").distinct().count() == 5
