"""Stand-in register tables built from the driver's TPC-H-like tables.

These only give rows in the register's schema (one aid row per ``lineitem``,
one measure row per ``part`` plus a second validity window for large parts);
none of the engine's work happens here. Each builder has a SQL twin used by the
DuckDB oracle; ``tests/test_standin.py`` checks the two agree.

Dimension joins are plain equi-joins: the optimizer broadcasts a side only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE
re-checks at runtime), otherwise it sort-merges; lineitem-orders is always a
shuffle join on the order key, and the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aidspark.schemas import AID_COLUMNS, MEASURE_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- fixed values: stand-in mappings (same text as in AID_RAW_SQL) -------------
SEGMENT_TO_TYPE = [("AUTOMOBILE", "PMI"), ("BUILDING", "Grande Impresa"),
                   ("FURNITURE", "Microimpresa"), ("HOUSEHOLD", "-")]
OTHER_TYPE = "Non classificata"
STATUS_TO_PROCEDURE = [("F", "De Minimis"), ("O", "Notifica")]
OTHER_PROCEDURE = "Esenzione"
FLAG_TO_INSTRUMENT = [("A", "Sovvenzione"), ("N", "Garanzia")]
OTHER_INSTRUMENT = "Prestito"
MEASURE_END_BY_SIZE_MOD4 = ["", "9999-12-31T00:00:00.000+01:00",
                            "2020-12-31T00:00:00.000+01:00", "2030-12-31T00:00:00.000+01:00"]
DATE_SUFFIX = "-01-01T00:00:00.000+01:00"


def _case(col, pairs, other):
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(other))


# Total order over line items standing in for file order (keep-last tests).
ARRIVAL_COLS = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                "l_discount", "l_tax"]


def aid_raw(spark: SparkSession, sf_dir: str, with_arrival: bool = False) -> DataFrame:
    """Raw aid layer stand-in: 31 columns, grain = one instrument row.

    ``with_arrival`` adds ``_arrival``, a total order over rows that plays the
    part of file order for keep-last dedup tests."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    p = table(spark, sf_dir, "part")
    s = table(spark, sf_dir, "supplier")
    # orders meet their customers before the line items, and these meet the narrow
    # tables first: where a side is too large to broadcast, fewer and narrower rows move
    # the last join is on the key as the register holds it, so that its shuffle also
    # deals the rows for whatever is grouped by grant (keep-last)
    cor = F.col("l_orderkey_cor")
    grants = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
              .withColumn("o_orderkey_cor", F.col("o_orderkey").cast("string")))
    j = (li.join(s, li.l_suppkey == s.s_suppkey)
         .join(p, li.l_partkey == p.p_partkey)
         .withColumn("l_orderkey_cor", F.col("l_orderkey").cast("string"))
         .join(grants, cor == F.col("o_orderkey_cor")))
    empty = F.lit("")
    cols = {
        "data_concessione": F.col("o_orderdate").cast("date").cast("string"),
        "car": F.col("l_partkey").cast("string"),
        "cor": cor,
        "denominazione_beneficiario": F.col("c_name"),
        "codice_fiscale_beneficiario": F.col("o_custkey").cast("string"),
        "tipo_beneficiario": _case(F.col("c_mktsegment"), SEGMENT_TO_TYPE, OTHER_TYPE),
        "regione_beneficiario": F.when(F.col("n_nationkey") == 0, empty).otherwise(F.col("n_name")),
        "soggetto_concedente": F.col("s_name"),
        "titolo_misura": F.col("p_name"),
        "des_tipo_misura": F.col("p_type"),
        "titolo_progetto": empty,
        "descrizione_progetto": empty,
        "cup": (F.when(F.col("l_linenumber") == 1, F.lit("n.d."))
                .when(F.col("l_linenumber") == 2, empty)
                .otherwise(F.concat(F.lit("CUP"), cor))),
        "atto_concessione": empty,
        "base_giuridica_nazionale": empty,
        "identificativo_ufficio": empty,
        "link_trasparenza_nazionale": empty,
        "id_componente": F.col("l_linenumber").cast("string"),
        "procedimento": _case(F.col("o_orderstatus"), STATUS_TO_PROCEDURE, OTHER_PROCEDURE),
        "cod_procedimento": F.col("o_orderstatus"),
        "regolamento_ue": empty,
        "cod_regolamento": empty,
        "obiettivo": F.expr("substr(o_orderpriority, 3)"),
        "cod_obiettivo": F.expr("substr(o_orderpriority, 1, 1)"),
        "settore_attivita": F.expr(
            "concat('(NACE 2) ', chr(cast(65 + p_size % 22 as int)), '.', cast(p_size as string))"),
        "cod_strumento": F.col("l_returnflag"),
        "strumento": _case(F.col("l_returnflag"), FLAG_TO_INSTRUMENT, OTHER_INSTRUMENT),
        "elemento_aiuto": F.when(F.col("l_discount") == 0, F.lit(None).cast("double"))
                           .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("double")),
        "importo_nominale": F.col("l_extendedprice"),
        "anno": F.year("o_orderdate").cast("int"),
        "mese": F.month("o_orderdate").cast("int"),
    }
    out = [cols[k].alias(k) for k in AID_COLUMNS]
    if with_arrival:
        out.append(F.struct(*ARRIVAL_COLS).alias("_arrival"))
    return j.select(*out)


def measure_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measure table stand-in: one row per part, and a second, later validity
    window for parts with ``p_size > 45`` (so ``car`` repeats, as in the source)."""
    p = table(spark, sf_dir, "part")

    def window(df, shift, end_expr):
        year = (F.lit(1994) + F.col("p_size") % 30 + F.lit(shift)).cast("int")
        cols = {
            "car": F.col("p_partkey").cast("string"),
            "car_padre": F.lit(""),
            "car_attivo": F.lit(""),
            "titolo_misura": F.col("p_name"),
            "des_tipo_misura": F.col("p_type"),
            "cod_tipo_misura": F.lit(""),
            "data_inizio_misura": F.concat(year.cast("string"), F.lit(DATE_SUFFIX)),
            "data_fine_misura": end_expr,
            "base_giuridica_nazionale": F.lit(""),
            "stato_membro": F.lit(""),
            "cod_amm": F.lit(""),
            "des_autorita": F.lit(""),
            "autorita_concedente": F.col("p_brand"),
            "importo_prestiti_garantiti": F.col("p_retailprice").cast("decimal(18,2)").cast("double"),
            "importo_aiuto_ad_hoc": F.when(F.col("p_size") % 7 == 0, F.lit(None).cast("double"))
                                     .otherwise(F.col("p_size").cast("double")),
            "link_aiuto": F.lit(""),
            "flag_quadro": F.lit(""),
            "flag_modifica_regime": F.lit(""),
            "anno": year,
            "mese": F.lit(1).cast("int"),
        }
        return df.select(*[cols[k].alias(k) for k in MEASURE_COLUMNS])

    m = F.col("p_size") % 4
    end = (F.when(m == 0, F.lit(MEASURE_END_BY_SIZE_MOD4[0]))
           .when(m == 1, F.lit(MEASURE_END_BY_SIZE_MOD4[1]))
           .when(m == 2, F.lit(MEASURE_END_BY_SIZE_MOD4[2]))
           .otherwise(F.lit(MEASURE_END_BY_SIZE_MOD4[3])))
    first = window(p, 0, end)
    second = window(p.where(F.col("p_size") > 45), 10, F.lit("2035-12-31T00:00:00.000+01:00"))
    return first.unionByName(second)


POPULATION_YEARS = (1997, 1998, 1999)


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population stand-in, several years: residents per region and year =
    customers per nation, each year with a part of them."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .withColumn("anno", F.explode(F.array(*map(F.lit, POPULATION_YEARS))))
            .where(F.col("c_custkey") % (F.col("anno") - POPULATION_YEARS[0] + 2) != 0)
            .groupBy("anno", F.col("n_name").alias("regione"))
            .agg(F.count(F.lit(1)).alias("popolazione")))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External entity table keyed by fiscal code: event users."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("codice_fiscale"),
                    F.col("event_type"), F.col("value"))


def cup_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CUP -> municipality bridge: one CUP per order, municipality = the
    nation of the order's customer."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(F.concat(F.lit("CUP"), F.col("o_orderkey").cast("string")).alias("cup"),
                    F.col("n_name").alias("comune")))


def territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Territory table keyed by region name: region -> macro area."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("regione"), F.col("r_name").alias("macro_area"))


# --- SQL twins for the oracle (DuckDB dialect, also valid Spark SQL) ----------

def _sql_case(col, pairs, other):
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in pairs) + f" ELSE '{other}' END"


AID_COLS_SQL = f"""
    CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS data_concessione,
    CAST(l.l_partkey AS VARCHAR) AS car,
    CAST(l.l_orderkey AS VARCHAR) AS cor,
    c.c_name AS denominazione_beneficiario,
    CAST(o.o_custkey AS VARCHAR) AS codice_fiscale_beneficiario,
    {_sql_case('c.c_mktsegment', SEGMENT_TO_TYPE, OTHER_TYPE)} AS tipo_beneficiario,
    CASE WHEN n.n_nationkey = 0 THEN '' ELSE n.n_name END AS regione_beneficiario,
    s.s_name AS soggetto_concedente,
    p.p_name AS titolo_misura,
    p.p_type AS des_tipo_misura,
    '' AS titolo_progetto,
    '' AS descrizione_progetto,
    CASE WHEN l.l_linenumber = 1 THEN 'n.d.' WHEN l.l_linenumber = 2 THEN ''
         ELSE 'CUP' || CAST(l.l_orderkey AS VARCHAR) END AS cup,
    '' AS atto_concessione,
    '' AS base_giuridica_nazionale,
    '' AS identificativo_ufficio,
    '' AS link_trasparenza_nazionale,
    CAST(l.l_linenumber AS VARCHAR) AS id_componente,
    {_sql_case('o.o_orderstatus', STATUS_TO_PROCEDURE, OTHER_PROCEDURE)} AS procedimento,
    o.o_orderstatus AS cod_procedimento,
    '' AS regolamento_ue,
    '' AS cod_regolamento,
    substr(o.o_orderpriority, 3) AS obiettivo,
    substr(o.o_orderpriority, 1, 1) AS cod_obiettivo,
    concat('(NACE 2) ', chr(CAST(65 + p.p_size % 22 AS INT)), '.', CAST(p.p_size AS VARCHAR)) AS settore_attivita,
    l.l_returnflag AS cod_strumento,
    {_sql_case('l.l_returnflag', FLAG_TO_INSTRUMENT, OTHER_INSTRUMENT)} AS strumento,
    CASE WHEN l.l_discount = 0 THEN CAST(NULL AS DOUBLE)
         ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS elemento_aiuto,
    l.l_extendedprice AS importo_nominale,
    CAST(year(o.o_orderdate) AS INT) AS anno,
    CAST(month(o.o_orderdate) AS INT) AS mese"""

AID_FROM_SQL = """
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey"""

AID_RAW_SQL = f"SELECT {AID_COLS_SQL}{AID_FROM_SQL}"
# With the arrival order as plain columns (for keep-last oracles).
AID_RAW_ARRIVAL_SQL = (f"SELECT {AID_COLS_SQL}, "
                       + ", ".join(f"l.{c} AS _a{i}" for i, c in enumerate(ARRIVAL_COLS))
                       + AID_FROM_SQL)
ARRIVAL_DESC_SQL = ", ".join(f"_a{i} DESC" for i in range(len(ARRIVAL_COLS)))


def _measure_window_sql(shift: int, end_sql: str, where: str = "") -> str:
    year = f"CAST(1994 + p_size % 30 + {shift} AS INT)"
    return f"""SELECT CAST(p_partkey AS VARCHAR) AS car, '' AS car_padre, '' AS car_attivo,
    p_name AS titolo_misura, p_type AS des_tipo_misura, '' AS cod_tipo_misura,
    CAST({year} AS VARCHAR) || '{DATE_SUFFIX}' AS data_inizio_misura,
    {end_sql} AS data_fine_misura, '' AS base_giuridica_nazionale, '' AS stato_membro,
    '' AS cod_amm, '' AS des_autorita, p_brand AS autorita_concedente,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS importo_prestiti_garantiti,
    CASE WHEN p_size % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END AS importo_aiuto_ad_hoc,
    '' AS link_aiuto, '' AS flag_quadro, '' AS flag_modifica_regime,
    {year} AS anno, CAST(1 AS INT) AS mese
  FROM part {where}"""


_END_SQL = ("CASE p_size % 4 " + " ".join(
    f"WHEN {i} THEN '{v}'" for i, v in enumerate(MEASURE_END_BY_SIZE_MOD4)) + " END")
MEASURE_RAW_SQL = (_measure_window_sql(0, _END_SQL) + "\n  UNION ALL\n"
                   + _measure_window_sql(10, "'2035-12-31T00:00:00.000+01:00'", "WHERE p_size > 45"))

POPULATION_SQL = """SELECT y.anno, n.n_name AS regione, COUNT(*) AS popolazione
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN (VALUES (1997), (1998), (1999)) AS y(anno) ON c.c_custkey % (y.anno - 1995) <> 0
  GROUP BY y.anno, n.n_name"""
ENTITIES_SQL = "SELECT CAST(user_id AS VARCHAR) AS codice_fiscale, event_type, value FROM events"
CUP_BRIDGE_SQL = """SELECT 'CUP' || CAST(o.o_orderkey AS VARCHAR) AS cup, n.n_name AS comune
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""
TERRITORY_SQL = """SELECT n.n_name AS regione, r.r_name AS macro_area
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""
