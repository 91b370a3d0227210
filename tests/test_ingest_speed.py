"""Per-record work of the ingest and of its dump (F1-F4, F6): literals are looked for
byte by byte, heads are read in small parts, sorted texts are not sorted again."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from aidspark.functions import text as T
from aidspark.sources import xml as X
from aidspark.sources import xml_standin as XS
from tests.conftest import SF_SMALL, write_text


def test_no_literal_is_counted_by_characters(spark, tmp_dir):
    write_text(tmp_dir, "f.xml", "<L>\n<AIUTO><COR>1</COR></AIUTO>\n</L>")
    plans = [X.read_aid_xml(spark, tmp_dir), XS.aid_xml_records(spark, SF_SMALL)]
    for df in plans:
        assert "instr(" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_dump_is_written_in_the_order_of_its_rows(spark, tmp_dir, monkeypatch):
    name, seen, text = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.text

    def write(self, path, *args, **kw):
        seen.append(spark.conf.get(name))
        return text(self, path, *args, **kw)
    monkeypatch.setattr(DataFrameWriter, "text", write)
    before = spark.conf.get(name)
    XS.write_aid_xml(spark, SF_SMALL, tmp_dir)
    assert seen == ["0"] and spark.conf.get(name) == before != "0"


def test_the_stem_keeps_rows_sorted(spark):
    # a stem that may be NULL is rewritten by the writer, which then sorts the texts again
    assert not XS.aid_xml_records(spark, SF_SMALL).schema["f"].nullable
    odd = spark.createDataFrame([(1998, 3), (12345, 11), (-5, 1), (None, 2)], "y int, m int")
    got = odd.select(XS._stem(F.col("y"), F.col("m")).alias("f"), F.format_string("OpenData_Aiuti_%04d_%02d", "y", "m").alias("g"))
    assert all(r["f"] == r["g"] for r in got.collect())


@pytest.mark.parametrize("ahead", [0, 900, 1015, 1020, 5000])
def test_first_tag_is_found_wherever_the_head_shows_it(spark, tmp_dir, ahead):
    write_text(tmp_dir, "f.xml", "<L>" + " " * ahead + "<n:AIUTO><n:COR>1</n:COR></n:AIUTO></L>")
    assert set(X.close_tags(spark, spark.read.text(tmp_dir).inputFiles(), "AIUTO").values()) == {"</n:AIUTO>"}


def test_plain_dates_read_as_all_others(spark):
    dates = ["2021-03-09", "2021-03", "2021-3-9", "2021-13-40", "2021-03-", "2021-03-0x", "2021-03-09\n", "02021-03-09", "2021", "", None]
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    parts = F.split("d", "-")
    y, m = T._int_part(parts, 0), F.when(F.size(parts) >= 2, T._int_part(parts, 1)).otherwise(F.lit(0))
    good = (F.coalesce("d", F.lit("")) != "") & y.isNotNull() & m.isNotNull()
    got = df.select(*T.year_month("d"), F.when(good, y).otherwise(0), F.when(good, m).otherwise(0)).collect()
    assert all((r[0], r[1]) == (r[2], r[3]) for r in got)
