"""Damaged text values built from ``lineitem`` for the value-level functions.

One row per line item: ``l_orderkey``, ``l_linenumber`` and a ``testo`` whose
damage depends on the line number. Spark builders and SQL twins produce the
same text; the functions under test then run over every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aidspark.sources.standin import table

KEYS = "l_orderkey, l_linenumber"

# Each entry: SQL expression valid in Spark SQL and DuckDB over lineitem.
CONTROL_TEXT = ("concat(l_returnflag, chr(l_linenumber), l_linestatus, chr(9), "
                "CAST(l_orderkey AS STRING), chr(l_linenumber + 24), chr(13))")

TAG_TEXT = """concat('<', CASE l_linenumber WHEN 1 THEN 'BASE_GIURIDICA_NAZ' WHEN 2 THEN 'IMPORTO_NOMIN'
      WHEN 3 THEN 'BASE_GIURIDICA_NAZIONALE' WHEN 4 THEN 'IMPORTO_NOMINALE' WHEN 5 THEN 'IMPORTO_NOMIN_X'
      WHEN 6 THEN 'BASE_GIURIDICA_NAZ attr="1"' ELSE 'IMPORTO_NOMINx' END, '>',
      CASE WHEN l_returnflag = 'R' THEN 'BASE_GIURIDICA_NAZ' ELSE CAST(l_orderkey AS STRING) END,
      '</', CASE l_linenumber WHEN 1 THEN 'BASE_GIURIDICA_NAZ' WHEN 2 THEN 'IMPORTO_NOMIN'
      WHEN 3 THEN 'BASE_GIURIDICA_NAZIONALE' WHEN 4 THEN 'IMPORTO_NOMINALE' WHEN 5 THEN 'IMPORTO_NOMIN_X'
      WHEN 6 THEN 'BASE_GIURIDICA_NAZ' ELSE 'IMPORTO_NOMINx' END, '>')"""

# Non-ASCII spaces are literal characters (no-break, en and ideographic space):
# chr() is ASCII-only in Spark.
SPACE_TEXT = ("CASE WHEN l_linenumber = 7 THEN CAST(NULL AS STRING) ELSE "
              "concat(' ', l_returnflag, chr(9), chr(10), ' ', l_linestatus, '  \u00a0', "
              "CAST(l_linenumber AS STRING), '\u2002 ', CAST(l_orderkey AS STRING), '\u3000 ') END")

AMOUNT_TEXT = """CASE l_linenumber
      WHEN 1 THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING), '.', ',')
      WHEN 2 THEN concat(CAST(l_orderkey AS STRING), '.234,56')
      WHEN 3 THEN CASE WHEN l_returnflag = 'N' THEN '-Inf' ELSE '' END
      WHEN 4 THEN 'n.d.'
      WHEN 5 THEN concat(CAST(l_orderkey AS STRING), '_5')
      WHEN 6 THEN concat(' ', CAST(l_linenumber AS STRING), ',5 ')
      ELSE concat(CAST(l_linenumber AS STRING), 'e2') END"""

DATE_TEXT = """CASE l_linenumber
      WHEN 1 THEN CAST(CAST(l_shipdate AS DATE) AS STRING)
      WHEN 2 THEN ''
      WHEN 3 THEN CAST(year(l_shipdate) AS STRING)
      WHEN 4 THEN 'invalid'
      WHEN 5 THEN concat(CAST(year(l_shipdate) AS STRING), '-xx')
      WHEN 6 THEN concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T00:00:00.000+01:00')
      ELSE concat(' ', CAST(year(l_shipdate) AS STRING), ' - ', CAST(month(l_shipdate) AS STRING)) END"""

TEXTS = {"control": CONTROL_TEXT, "tag": TAG_TEXT, "space": SPACE_TEXT,
         "amount": AMOUNT_TEXT, "date": DATE_TEXT}


def text_values(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.expr(TEXTS[kind]).alias("testo"))


def text_values_sql(kind: str) -> str:
    return f"SELECT {KEYS}, {TEXTS[kind]} AS testo FROM lineitem"
