"""XML dumps generated from the driver tables, with the source's known damage.

Gives the ingest jobs input in the shape they expect: ``OpenData_Aiuti_YYYY_MM``
folders of ``<AIUTO>`` records, one record per stand-in aid row plus one record
without components per order that has no line items. Rows with return flag R
carry a second instrument in their component, and line-1 rows a second
component without instruments. Damage is injected by rules on the row's line
number (``id_componente``):

  1  child tag with a namespace prefix       5  whitespace noise, decimal comma
  2  truncated tag names                      6  illegal character reference
  3  control bytes in text and between tags   7  unclosed element (malformed)
  4  bare ampersand in text

Orders with status 'P' among the component-less grants have no grant date
(year 0, rejected downstream). The SQL twins below describe, row for row, what
a correct ingest must return; nothing here parses or flattens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aidspark.schemas import (COMPONENT_FIELDS, GRANT_FIELDS, INSTRUMENT_AMOUNT_FIELDS,
                              INSTRUMENT_TEXT_FIELDS, MEASURE_FIELDS)
from aidspark.session import several_files_at_once
from aidspark.sources import standin as S

MALFORMED_LINE = "7"
UNDATED_STATUS = "P"
SECOND_INSTRUMENT_FLAG, SECOND_INSTRUMENT = "R", "Garanzia"
BARE_COMPONENT_SECTOR = "(NACE 2) Z.0"


def _esc(v: Column) -> Column:
    """XML-escape text; values without '&', '<' or '>' (almost all) skip the
    replacements after three literal searches."""
    special = v.contains("&") | v.contains("<") | v.contains(">")
    escaped = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    return F.when(special, escaped).otherwise(v)


def _elem(tag, value: Column, raw: bool = False) -> Column:
    """``<tag>value</tag>``, or NULL when value is NULL. ``tag`` may be a Column."""
    body = value if raw else _esc(value)
    if isinstance(tag, str):
        return F.concat(F.lit(f"<{tag}>"), body, F.lit(f"</{tag}>"))
    return F.concat(F.lit("<"), tag, F.lit(">"), body, F.lit("</"), tag, F.lit(">"))


def _stem(year: Column, month: Column) -> Column:
    """The file stem of a month. Never NULL; the general form is a formatter's work
    for each row, so only odd years go through it."""
    plain = F.concat(F.lit("OpenData_Aiuti_"), F.lpad(year.cast("string"), 4, "0"), F.lit("_"), F.lpad(month.cast("string"), 2, "0"))
    return F.coalesce(F.when(year.between(0, 9999), plain), F.format_string("OpenData_Aiuti_%04d_%02d", year, month))


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.table(spark, sf_dir, "orders")
    li = S.table(spark, sf_dir, "lineitem")
    c = S.table(spark, sf_dir, "customer")
    n = S.table(spark, sf_dir, "nation")
    return (o.join(li, o.o_orderkey == li.l_orderkey, "left_anti")
            .join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey))


def _line_rows(spark: SparkSession, sf_dir: str, with_arrival: bool) -> DataFrame:
    """The stand-in rows and their file stem."""
    return (S.aid_raw(spark, sf_dir, with_arrival=with_arrival)
            .withColumn("f", _stem(F.col("anno"), F.col("mese"))))


def _record_text() -> Column:
    """The record text of a row; a grant without line items (``_line`` false) has
    no components, and no element for what it has no value of."""
    line = F.col("id_componente")
    grant_cols = {col: F.col(col) for _t, col in GRANT_FIELDS}
    name = F.col("denominazione_beneficiario")
    grant_cols["denominazione_beneficiario"] = (
        F.when(line == "3", F.concat(F.lit("\x01"), name, F.lit("\x0b")))
        .when(line == "5", F.concat(F.lit("  "), name, F.lit(" \n\t ")))
        .otherwise(name))
    parts = []
    for tag, col in GRANT_FIELDS:
        if col == "titolo_progetto":
            parts.append(F.when(line == "4", F.lit("<TITOLO_PROGETTO>R&D</TITOLO_PROGETTO>"))
                         .otherwise(_elem(tag, grant_cols[col])))
        elif col == "descrizione_progetto":
            parts.append(F.when(line == "6", F.lit("<DESCRIZIONE_PROGETTO>&#1;</DESCRIZIONE_PROGETTO>"))
                         .otherwise(_elem(tag, grant_cols[col])))
        elif col == "base_giuridica_nazionale":
            parts.append(_elem(F.when(line == "2", F.lit("BASE_GIURIDICA_NAZ")).otherwise(F.lit(tag)),
                               grant_cols[col]))
        elif col == "cup":
            parts.append(_elem(F.when(line == "1", F.lit("n:CUP")).otherwise(F.lit(tag)), grant_cols[col]))
        else:
            parts.append(_elem(tag, grant_cols[col]))
    comp = [_elem(tag, F.col(col)) for tag, col in COMPONENT_FIELDS]
    nominal = F.col("importo_nominale").cast("string")
    nominal = F.when(line == "5", F.regexp_replace(nominal, r"\.", ",")).otherwise(nominal)
    inst = [_elem(tag, F.col(col)) for tag, col in INSTRUMENT_TEXT_FIELDS]
    inst.append(_elem("ELEMENTO_DI_AIUTO", F.col("elemento_aiuto").cast("string")))
    inst.append(_elem(F.when(line == "2", F.lit("IMPORTO_NOMIN")).otherwise(F.lit("IMPORTO_NOMINALE")), nominal))
    # A second instrument in the same component for one return flag, and a
    # second component without instruments on line 1.
    second = F.when(F.col("cod_strumento") == SECOND_INSTRUMENT_FLAG, F.concat_ws("",
        F.lit("<STRUMENTO_AIUTO>"), _elem("COD_STRUMENTO", F.concat(F.col("cod_strumento"), F.lit("2"))),
        F.lit(f"<DES_STRUMENTO>{SECOND_INSTRUMENT}</DES_STRUMENTO>"),
        _elem("IMPORTO_NOMINALE", F.col("importo_nominale").cast("string")),
        F.lit("</STRUMENTO_AIUTO>")))
    bare_component = F.when(line == "1", F.lit(
        f"<COMPONENTE_AIUTO><ID_COMPONENTE_AIUTO>0</ID_COMPONENTE_AIUTO>"
        f"<SETTORE_ATTIVITA>{BARE_COMPONENT_SECTOR}</SETTORE_ATTIVITA></COMPONENTE_AIUTO>"))
    # concat_ws leaves out NULLs: an element without a value, a part that a row has not
    components = F.concat_ws("",
        F.lit("<COMPONENTI_AIUTO><COMPONENTE_AIUTO>"), *comp,
        F.lit("<STRUMENTI_AIUTO><STRUMENTO_AIUTO>"), *inst, F.lit("</STRUMENTO_AIUTO>"), second,
        F.lit("</STRUMENTI_AIUTO></COMPONENTE_AIUTO>"), bare_component, F.lit("</COMPONENTI_AIUTO>"),
        F.when(line == MALFORMED_LINE, F.lit("<NOTE>unclosed")))
    return F.concat_ws("",
        F.lit("\n<AIUTO>"), F.when(line == "3", F.lit("\x02")), *parts, F.when(F.col("_line"), components), F.lit("</AIUTO>"))


def _orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grants of orders without line items, as far as they have fields, and
    their file stem."""
    date = F.col("o_orderdate").cast("date").cast("string")
    ogrant = {
        "data_concessione": F.when(F.col("o_orderstatus") == UNDATED_STATUS, F.lit("")).otherwise(date),
        "cor": F.col("o_orderkey").cast("string"),
        "denominazione_beneficiario": F.col("c_name"),
        "codice_fiscale_beneficiario": F.col("o_custkey").cast("string"),
        "tipo_beneficiario": S._case(F.col("c_mktsegment"), S.SEGMENT_TO_TYPE, S.OTHER_TYPE),
        "regione_beneficiario": F.when(F.col("n_nationkey") == 0, F.lit("")).otherwise(F.col("n_name")),
    }
    stem = _stem(F.year("o_orderdate"), F.month("o_orderdate"))
    return _orphans(spark, sf_dir).select(*[ogrant[col].alias(col) for _t, col in GRANT_FIELDS if col in ogrant], stem.alias("f"))


def aid_xml_records(spark: SparkSession, sf_dir: str, with_arrival: bool = False,
                    arrange=lambda rows: rows) -> DataFrame:
    """(f, value): target file stem and one ``<AIUTO>`` record text; with
    ``_arrival`` (the stand-in row order) when asked. ``arrange`` (filters, a
    shuffle, a sort) works on the rows that the texts are made of, which are a
    fifth of their size."""
    a, orph = _line_rows(spark, sf_dir, with_arrival), _orphan_rows(spark, sf_dir)
    rows = arrange(a.withColumn("_line", F.lit(True)).unionByName(orph.withColumn("_line", F.lit(False)), allowMissingColumns=True))
    return rows.select("f", _record_text().alias("value"), *(["_arrival"] if with_arrival else []))


#: Records of one file of a dump, and how files are written: compressed, as the
#: text is ten times the rows' size and more.
FILE_RECORDS = 20_000
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(FILE_RECORDS)}


def _by_stem(rows: DataFrame) -> DataFrame:
    """Sorted as the writer needs them, before they are made texts."""
    return rows.sortWithinPartitions("f")


def _in_order(rows: DataFrame) -> DataFrame:
    """Range-partitioned and sorted by (stem, arrival): part-file name order and
    position inside a file follow arrival order."""
    return rows.repartitionByRange("f", "_arrival").sortWithinPartitions("f", "_arrival")


def _write(records: DataFrame, out_dir: str) -> str:
    """Write (f, value) rows that are sorted by ``f``, one folder per stem.

    A task writes one file after the other, as its rows come. With several files open
    at once (``maxConcurrentOutputFileWriters``) the writer takes no notice of their
    order and sorts the texts again as soon as there are more stems than that."""
    with several_files_at_once(records.sparkSession, 0):
        records.select("f", "value").write.mode("overwrite").options(**GZIP).partitionBy("f").text(out_dir)
    return out_dir


def write_aid_drop(spark: SparkSession, sf_dir: str, out_dir: str, which: Column) -> str:
    """The records of the stems that ``which`` takes, in arrival order."""
    return _write(aid_xml_records(spark, sf_dir, with_arrival=True, arrange=lambda rows: _in_order(rows.where(which))), out_dir)


def write_aid_xml(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    """Write the dump as one folder per source month; returns ``out_dir``."""
    return _write(aid_xml_records(spark, sf_dir, arrange=_by_stem), out_dir)


#: Breaks of a record's markup, one for each remainder of its text's hash (pattern,
#: replacement); none of them touches a value.
BREAKS = [(r"</(?:n:)?CUP>", ""), ("<COR>", "</NOTE></STRUMENTI_AIUTO><COR>"), (r"(?s)^(.*?)</COMPONENTE_AIUTO>", "$1"),
          ("</STRUMENTO_AIUTO></STRUMENTI_AIUTO>", "</STRUMENTI_AIUTO>"), ("<COR>", "<COR id= >"), ("</COMPONENTI_AIUTO>", ""),
          ("</STRUMENTI_AIUTO></COMPONENTE_AIUTO>", "</COMPONENTE_AIUTO></STRUMENTI_AIUTO>")]


def write_damaged_aid_xml(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    """The dump with broken markup in all records but those of the last remainder."""
    records = aid_xml_records(spark, sf_dir, arrange=_by_stem)
    kind, value = F.pmod(F.xxhash64("value"), F.lit(len(BREAKS) + 1)), F.col("value")
    for i, (pattern, replacement) in enumerate(BREAKS):
        value = F.when(kind == i, F.regexp_replace("value", pattern, replacement)).otherwise(value)
    return _write(records.withColumn("value", value), out_dir)


def write_prefixed_aid_xml(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    """The dump with a namespace prefix on every tag."""
    value = F.regexp_replace("value", "<(/?)([A-Z])", "<$1ns2:$2")
    return _write(aid_xml_records(spark, sf_dir, arrange=_by_stem).withColumn("value", value), out_dir)


MEASURE_STEM = "OpenData_Misura_cumulativo"


def measure_xml_records(spark: SparkSession, sf_dir: str, arrange=lambda rows: rows) -> DataFrame:
    """One ``<MISURA>`` per stand-in measure row. Rows whose ``p_size``-derived
    start year is odd get whitespace noise, a decimal comma and truncated tags."""
    m = arrange(S.measure_raw(spark, sf_dir))
    odd = (F.col("anno") % 2) == 1
    parts = []
    for tag, col, kind in MEASURE_FIELDS:
        v = F.col(col).cast("string")
        if kind == "amount":
            v = F.when(odd, F.regexp_replace(v, r"\.", ",")).otherwise(v)
        elif col == "titolo_misura":
            v = F.when(odd, F.concat(F.lit(" \t"), v, F.lit("\n "))).otherwise(v)
        t = F.when(odd & F.lit(tag == "BASE_GIURIDICA_NAZIONALE"), F.lit("BASE_GIURIDICA_NAZ")).otherwise(F.lit(tag))
        parts.append(_elem(t, v))
    record = F.concat_ws("", F.lit("\n<MISURA>"), *parts, F.lit("</MISURA>"))
    return m.select(F.lit(MEASURE_STEM).alias("f"), record.alias("value"))


def write_measure_xml(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    """Write the dump, whose records all have one stem: their rows are dealt to the
    tasks, and each task writes files of ``FILE_RECORDS`` to that folder."""
    records = measure_xml_records(spark, sf_dir, arrange=lambda rows: rows.hint("rebalance"))
    records.select("value").write.mode("overwrite").options(**GZIP).text(f"{out_dir}/f={MEASURE_STEM}")
    return out_dir


# --- SQL twins: expected flat rows (DuckDB dialect) ---------------------------

def _aid_twin_cols(**override):
    out = []
    for _t, col in GRANT_FIELDS + COMPONENT_FIELDS + INSTRUMENT_TEXT_FIELDS + INSTRUMENT_AMOUNT_FIELDS:
        if col in override:
            out.append(f"{override[col]} AS {col}")
        elif col == "titolo_progetto":
            out.append("CASE WHEN id_componente = '4' THEN 'R&D' ELSE '' END AS titolo_progetto")
        else:
            out.append(col)
    return ", ".join(out + ["anno", "mese"])


_SECOND = dict(cod_strumento="cod_strumento || '2'", strumento=f"'{SECOND_INSTRUMENT}'",
               elemento_aiuto="CAST(NULL AS DOUBLE)")
_BARE = dict({c: "''" for _t, c in COMPONENT_FIELDS + INSTRUMENT_TEXT_FIELDS},
             id_componente="'0'", settore_attivita=f"'{BARE_COMPONENT_SECTOR}'",
             elemento_aiuto="CAST(NULL AS DOUBLE)", importo_nominale="CAST(NULL AS DOUBLE)")


def _line_rows_sql(raw_sql: str, extra_cols: str, where: str = "TRUE", malformed: bool = False) -> str:
    """Flat rows of the line-item records: main instrument, second
    instrument, bare component; with ``malformed`` of those records too."""
    sound = "TRUE" if malformed else f"id_componente != '{MALFORMED_LINE}'"
    base = f"FROM ({raw_sql}) a WHERE {sound} AND {where}"
    return f"""SELECT {_aid_twin_cols()}{extra_cols} {base}
UNION ALL SELECT {_aid_twin_cols(**_SECOND)}{extra_cols} {base} AND cod_strumento = '{SECOND_INSTRUMENT_FLAG}'
UNION ALL SELECT {_aid_twin_cols(**_BARE)}{extra_cols} {base} AND id_componente = '1'"""


def _orphan_twin_cols():
    keep = {
        "data_concessione": f"CASE WHEN o.o_orderstatus = '{UNDATED_STATUS}' THEN '' "
                            "ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END",
        "cor": "CAST(o.o_orderkey AS VARCHAR)",
        "denominazione_beneficiario": "c.c_name",
        "codice_fiscale_beneficiario": "CAST(o.o_custkey AS VARCHAR)",
        "tipo_beneficiario": S._sql_case("c.c_mktsegment", S.SEGMENT_TO_TYPE, S.OTHER_TYPE),
        "regione_beneficiario": "CASE WHEN n.n_nationkey = 0 THEN '' ELSE n.n_name END",
    }
    out = []
    for _t, col in GRANT_FIELDS + COMPONENT_FIELDS + INSTRUMENT_TEXT_FIELDS:
        out.append(f"{keep.get(col, chr(39) * 2)} AS {col}")
    out += ["CAST(NULL AS DOUBLE) AS elemento_aiuto", "CAST(NULL AS DOUBLE) AS importo_nominale",
            f"CASE WHEN o.o_orderstatus = '{UNDATED_STATUS}' THEN 0 ELSE CAST(year(o.o_orderdate) AS INT) END AS anno",
            f"CASE WHEN o.o_orderstatus = '{UNDATED_STATUS}' THEN 0 ELSE CAST(month(o.o_orderdate) AS INT) END AS mese",
            "CAST(year(o.o_orderdate) AS INT) AS _file_year",
            "CAST(month(o.o_orderdate) AS INT) AS _file_month"]
    return ", ".join(out)


_ARRIVAL_COLS = ", ".join(f"_a{i}" for i in range(len(S.ARRIVAL_COLS)))
_ORPHANS_FROM = """FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"""

# All well-formed records flattened (year-0 rows included), with the year and
# month of the file each row was written to.
AID_XML_FLAT_SQL = f"""
{_line_rows_sql(S.AID_RAW_SQL, ", anno AS _file_year, mese AS _file_month")}
UNION ALL
SELECT {_orphan_twin_cols()}
{_ORPHANS_FROM}"""

# The same with the malformed records, as salvage reads them.
AID_XML_SALVAGED_SQL = f"""
{_line_rows_sql(S.AID_RAW_SQL, ", anno AS _file_year, mese AS _file_month", malformed=True)}
UNION ALL
SELECT {_orphan_twin_cols()}
{_ORPHANS_FROM}"""

# Well-formed, dated rows with the stand-in arrival order (NULL for orphans).
AID_XML_ARRIVAL_SQL = f"""
{_line_rows_sql(S.AID_RAW_ARRIVAL_SQL, ", " + _ARRIVAL_COLS, "anno != 0")}
UNION ALL
SELECT * EXCLUDE (_file_year, _file_month), {", ".join(f"NULL AS _a{i}" for i in range(len(S.ARRIVAL_COLS)))}
FROM ({"SELECT " + _orphan_twin_cols()}
      {_ORPHANS_FROM}) x WHERE anno != 0"""

# Every record written, with its file and whether it is malformed.
AID_XML_RECORDS_SQL = f"""
SELECT printf('OpenData_Aiuti_%04d_%02d', anno, mese) AS fonte,
       CASE WHEN id_componente = '{MALFORMED_LINE}' THEN 1 ELSE 0 END AS bad
FROM ({S.AID_RAW_SQL}) a
UNION ALL
SELECT printf('OpenData_Aiuti_%04d_%02d', CAST(year(o.o_orderdate) AS INT), CAST(month(o.o_orderdate) AS INT)), 0
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"""
