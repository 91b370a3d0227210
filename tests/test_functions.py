"""Value-level expressions (S3-S7) and money rounding."""

import pytest
from pyspark.sql import functions as F

from aidspark.functions.money import pct, round_double
from aidspark.functions.nace import UNCLASSIFIED, macro_sector
from aidspark.functions.text import (normalize_text, parse_amount, repair_truncated_tags,
                                     scrub_control_chars, year_month)


def _one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("o")).first().o


@pytest.mark.parametrize("text,expected", [
    ("2023-06-15", (2023, 6)), ("", (0, 0)), ("2023", (2023, 0)), ("invalid", (0, 0)),
    ("2023-xx-01", (0, 0)), ("2021-11-05T00:00:00.000+01:00", (2021, 11)), (None, (0, 0)),
])
def test_year_month(spark, text, expected):
    df = spark.createDataFrame([(text,)], "d string")
    y, m = year_month(F.col("d"))
    r = df.select(y.alias("y"), m.alias("m")).first()
    assert (r.y, r.m) == expected


def test_scrub_control_chars(spark):
    assert _one(spark, scrub_control_chars, "<r>\x00a\x01b\x02c</r>") == "<r>abc</r>"
    kept = "<r>a\tb\nc\rd</r>"
    assert _one(spark, scrub_control_chars, kept) == kept


@pytest.mark.parametrize("text,expected", [
    ("<BASE_GIURIDICA_NAZ>x</BASE_GIURIDICA_NAZ>", "<BASE_GIURIDICA_NAZIONALE>x</BASE_GIURIDICA_NAZIONALE>"),
    ("<IMPORTO_NOMIN>5</IMPORTO_NOMIN>", "<IMPORTO_NOMINALE>5</IMPORTO_NOMINALE>"),
    ("<BASE_GIURIDICA_NAZ/>", "<BASE_GIURIDICA_NAZIONALE/>"),
    ("<BASE_GIURIDICA_NAZ attr='1'>", "<BASE_GIURIDICA_NAZIONALE attr='1'>"),
    ("<IMPORTO_NOMINALE>5</IMPORTO_NOMINALE>", "<IMPORTO_NOMINALE>5</IMPORTO_NOMINALE>"),
    ("<BASE_GIURIDICA_NAZIONALE>x</BASE_GIURIDICA_NAZIONALE>", "<BASE_GIURIDICA_NAZIONALE>x</BASE_GIURIDICA_NAZIONALE>"),
    ("<IMPORTO_NOMIN_X>1</IMPORTO_NOMIN_X>", "<IMPORTO_NOMIN_X>1</IMPORTO_NOMIN_X>"),
    ("<CAR>1</CAR>", "<CAR>1</CAR>"),
    ("<A><IMPORTO_NOMIN>1</IMPORTO_NOMIN><IMPORTO_NOMINALE>2</IMPORTO_NOMINALE></A>",
     "<A><IMPORTO_NOMINALE>1</IMPORTO_NOMINALE><IMPORTO_NOMINALE>2</IMPORTO_NOMINALE></A>"),
])
def test_repair_truncated_tags(spark, text, expected):
    assert _one(spark, repair_truncated_tags, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("  a \t b\n\nc ", "a b c"), (None, ""), ("x  y　", "x y"), ("", ""),
])
def test_normalize_text(spark, text, expected):
    assert _one(spark, normalize_text, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("1500,50", 1500.5), ("10000.00", 10000.0), (" 7,5 ", 7.5), ("1_000", 1000.0), ("1e3", 1000.0),
    ("1.234,56", None), ("", None), (None, None), ("n.d.", None), ("1.0d", None), (".5", 0.5),
])
def test_parse_amount(spark, text, expected):
    assert _one(spark, parse_amount, text) == expected


def test_rounding_is_engine_independent(spark):
    df = spark.createDataFrame([(1.005, 2.5, 1.0, 3.0)], "a double, b double, n double, d double")
    r = df.select(round_double(F.col("a"), 2).alias("a"), round_double(F.col("b"), 0).alias("b"),
                  pct(F.col("n"), F.col("d"), 2).alias("p")).first()
    assert (r.a, r.b, r.p) == (1.01, 3.0, 33.33)


@pytest.mark.parametrize("code,label", [
    ("(NACE 2) C.28.2", "C - Manifatturiero"), ("(NACE 2) S.96", "S - Altri servizi"),
    ("(NACE 2) T.97", UNCLASSIFIED), ("(NACE 2) C28", UNCLASSIFIED), ("C.28", UNCLASSIFIED),
])
def test_macro_sector(spark, code, label):
    assert _one(spark, macro_sector, code) == label


@pytest.mark.parametrize("text,expected", [
    ("<n:CUP>x</n:CUP>", "<CUP>x</CUP>"),
    ("<A>\x01b\x1f</A>", "<A>b</A>"),
    ("<A>R&D &#1;x &#x1F;y &#9;z &amp; &lt;</A>", "<A>R&amp;D x y &#9;z &amp; &lt;</A>"),
    ("<IMPORTO_NOMIN>1</IMPORTO_NOMIN>", "<IMPORTO_NOMINALE>1</IMPORTO_NOMINALE>"),
    ("<a:B c='http://x'>1</a:B>", "<B c='http://x'>1</B>"),
])
def test_repair_record(spark, text, expected):
    from aidspark.functions.text import repair_record, repair_xml
    assert _one(spark, repair_record, text) == expected
    if ":" not in text.split(">")[0]:
        assert _one(spark, repair_xml, text) == expected
