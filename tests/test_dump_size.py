"""The generated dumps stay a small part of their text on disk."""

import glob
import gzip
import os

from pyspark.sql import functions as F

from aidspark.sources import xml as X
from aidspark.sources import xml_standin as XS
from tests.conftest import SF_SMALL


def _sizes(path):
    files = [f for f in glob.glob(f"{path}/**/part-*", recursive=True)]
    text = 0
    for f in files:
        with gzip.open(f) as stream:
            text += len(stream.read())
    return len(files), sum(map(os.path.getsize, files)), text


def test_dump_is_compressed_and_whole(spark, tmp_dir):
    XS.write_aid_xml(spark, SF_SMALL, tmp_dir)
    _, disk, text = _sizes(tmp_dir)
    assert disk * 4 < text
    rows = XS.aid_xml_records(spark, SF_SMALL).count()
    assert spark.read.option("lineSep", "</AIUTO>").option("recursiveFileLookup", "true").text(tmp_dir).where(
        F.col("value").contains("<AIUTO>")).count() == rows


def test_files_are_bounded(spark, tmp_dir, monkeypatch):
    monkeypatch.setitem(XS.GZIP, "maxRecordsPerFile", "50")
    XS.write_measure_xml(spark, SF_SMALL, tmp_dir)
    n = XS.measure_xml_records(spark, SF_SMALL).count()
    files, disk, text = _sizes(tmp_dir)
    assert files >= n / 50 and disk * 2 < text
    assert X.read_measure_xml(spark, tmp_dir).where(F.col("r").isNotNull()).count() == n


def test_single_open_tag_is_cut_like_the_pattern(spark):
    chunks = ["\n<AIUTO><COR>1</COR>", "è<AIUTO a='1'>x", "<AIUTOX>y", "<AIUTO><COR>1<AIUTO><COR>2", "<n:AIUTO>z</n:AIUTO>", "AIUTO"]
    df = spark.createDataFrame([(f"f{i}", 0, c) for i, c in enumerate(chunks)], "_file string, _block long, value string")
    got = sorted((r["_file"], r["record"]) for r in X.to_records(df, "AIUTO").collect())
    assert got == [("f0", "<AIUTO><COR>1</COR></AIUTO>"), ("f1", "<AIUTO a='1'>x</AIUTO>"), ("f3", "<AIUTO><COR>1"),
                   ("f3", "<AIUTO><COR>2</AIUTO>"), ("f4", "<n:AIUTO>z</n:AIUTO>")]


def test_measure_rows_are_not_sorted_to_be_written(spark, tmp_dir):
    """The one task that sorted all records held them in memory."""
    XS.write_measure_xml(spark, SF_SMALL, tmp_dir)
    plan = XS.measure_xml_records(spark, SF_SMALL, arrange=lambda r: r.hint("rebalance"))._jdf.queryExecution().toString()
    assert "Exchange RoundRobin" in plan or "REBALANCE" in plan.upper()
    assert [os.path.basename(d) for d in glob.glob(f"{tmp_dir}/f=*")] == [f"f={XS.MEASURE_STEM}"]
