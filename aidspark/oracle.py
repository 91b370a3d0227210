"""Independent SQL oracle (DuckDB dialect) for every registered query.

Each statement starts from the stand-in CTEs over the driver tables and states
the same semantics in plain SQL, with the rounding rules of
``aidspark.functions.money`` written out (exact decimal sums, ratios rounded
through DECIMAL(38,8), explicit tie-breakers for ROW_NUMBER and LIMIT).
"""

from __future__ import annotations

from aidspark.functions.nace import UNCLASSIFIED, macro_sector_sql
from aidspark.schemas import AID_COLUMNS
from aidspark.sources import standin as S

E = "elemento_aiuto"
CF = "codice_fiscale_beneficiario"


def tot(x: str = E) -> str:
    return f"SUM(TRY_CAST({x} AS DECIMAL(28,8)))"


def rtot(x: str = E) -> str:
    return f"CAST(ROUND({tot(x)}, 0) AS DOUBLE)"


def mean(x: str = E) -> str:
    return f"ROUND(CAST({tot(x)} AS DOUBLE) / NULLIF(COUNT(TRY_CAST({x} AS DECIMAL(28,8))), 0), 0)"


def rd(expr: str, d: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,8)), {d}) AS DOUBLE)"


def pct(num: str, den: str, d: int = 2) -> str:
    return rd(f"CAST({num} AS DOUBLE) * 100.0 / NULLIF(CAST({den} AS DOUBLE), 0)", d)


def share(partition: str, x: str = E) -> str:
    over = f"OVER (PARTITION BY {partition})" if partition else "OVER ()"
    return pct(tot(x), f"SUM({tot(x)}) {over}")


_CLEAN_COLS = ", ".join(
    "COALESCE(NULLIF(regione_beneficiario, ''), 'ND') AS regione_beneficiario"
    if c == "regione_beneficiario" else c for c in AID_COLUMNS)

WITH_RAW = f"WITH raw AS ({S.AID_RAW_SQL})"
WITH_CLEAN = f"{WITH_RAW},\nclean AS (SELECT {_CLEAN_COLS} FROM raw WHERE elemento_aiuto IS NOT NULL)"
WITH_MEASURES = f"WITH measures AS ({S.MEASURE_RAW_SQL})"


def _q(prefix: str, body: str) -> str:
    return f"{prefix}\n{body}"


def _active(col: str = "data_fine_misura", cutoff: str = "2026-01-01") -> str:
    return f"({col} IS NULL OR {col} = '' OR {col} LIKE '9999%' OR {col} > '{cutoff}')"


MARTS = {
    "clean_aid": _q(WITH_CLEAN, "SELECT * FROM clean"),
    "clean_measure": _q(WITH_MEASURES, "SELECT * FROM measures"),
    "mart_per_regione": _q(WITH_CLEAN, f"""
SELECT anno, regione_beneficiario, COUNT(DISTINCT {CF}) AS imprese, COUNT(*) AS aiuti,
       {rtot()} AS totale_esl, {mean()} AS media_esl
FROM clean WHERE regione_beneficiario != 'ND'
GROUP BY anno, regione_beneficiario"""),
    "mart_per_procedimento": _q(WITH_CLEAN, f"""
SELECT anno, procedimento, COUNT(*) AS aiuti, {rtot()} AS totale_esl
FROM clean WHERE procedimento != ''
GROUP BY anno, procedimento"""),
    "mart_top_beneficiari": _q(WITH_CLEAN, f"""
SELECT {CF}, denominazione_beneficiario, regione_beneficiario, COUNT(*) AS aiuti,
       {rtot()} AS totale_esl, {mean()} AS media_esl
FROM clean WHERE {CF} != ''
GROUP BY {CF}, denominazione_beneficiario, regione_beneficiario
ORDER BY totale_esl DESC, {CF}, denominazione_beneficiario, regione_beneficiario
LIMIT 1000"""),
    "mart_per_obiettivo": _q(WITH_CLEAN, f"""
SELECT anno, cod_obiettivo, obiettivo, COUNT(*) AS aiuti, COUNT(DISTINCT {CF}) AS imprese,
       {rtot()} AS totale_esl, {mean()} AS media_esl, {share('anno')} AS quota_pct_su_anno
FROM clean WHERE cod_obiettivo IS NOT NULL AND cod_obiettivo != ''
GROUP BY anno, cod_obiettivo, obiettivo"""),
    "mart_per_strumento": _q(WITH_CLEAN, f"""
SELECT anno, strumento, COUNT(*) AS aiuti, {rtot()} AS totale_esl, {mean()} AS media_esl,
       {share('anno')} AS quota_pct_su_anno,
       CAST(ROW_NUMBER() OVER (PARTITION BY anno ORDER BY {tot()} DESC, strumento) AS BIGINT) AS rank_per_anno
FROM clean WHERE strumento IS NOT NULL AND strumento != ''
GROUP BY anno, strumento"""),
    "mart_tipo_beneficiario": _q(WITH_CLEAN, f"""
SELECT anno, tipo_beneficiario, regione_beneficiario, COUNT(DISTINCT {CF}) AS imprese,
       COUNT(*) AS aiuti, {rtot()} AS totale_esl, {mean()} AS media_esl,
       {share('anno, regione_beneficiario')} AS quota_pct_su_regione
FROM clean
WHERE tipo_beneficiario IS NOT NULL AND tipo_beneficiario != '-' AND regione_beneficiario != 'ND'
GROUP BY anno, tipo_beneficiario, regione_beneficiario"""),
}

_SECTORS = _q(WITH_CLEAN, f""",
settori AS (
  SELECT anno, regione_beneficiario AS regione, {macro_sector_sql('settore_attivita')} AS macro_settore,
         {E}, {CF}
  FROM clean
  WHERE settore_attivita IS NOT NULL AND settore_attivita != '' AND regione_beneficiario != 'ND')
SELECT anno, regione, macro_settore, COUNT(*) AS aiuti, COUNT(DISTINCT {CF}) AS imprese,
       {rtot()} AS totale_esl, {mean()} AS media_esl,
       {share('anno, regione')} AS quota_pct_su_regione,
       CAST(ROW_NUMBER() OVER (PARTITION BY anno, regione ORDER BY {tot()} DESC, macro_settore) AS BIGINT)
         AS rank_in_regione
FROM settori WHERE macro_settore != '{UNCLASSIFIED}'
GROUP BY anno, regione, macro_settore""")
MARTS["mart_settore_regione"] = _SECTORS
MARTS["mart_settori"] = _SECTORS

# One grouped query: the shares of a type are conditional sums over the sum of
# the rows that name any type.
_TYPED = "tipo_beneficiario IS NOT NULL AND tipo_beneficiario <> '-'"


def _type_share(label: str) -> str:
    own = f"tipo_beneficiario = '{label}'"
    return (f"CASE WHEN COUNT(*) FILTER (WHERE {own}) > 0 THEN "
            + pct(f"{tot()} FILTER (WHERE {own})", f"{tot()} FILTER (WHERE {_TYPED})") + " END")


MARTS["mart_territorio"] = _q(WITH_CLEAN, f""",
per_luogo AS (
  SELECT anno, regione_beneficiario AS regione,
         COUNT(DISTINCT {CF}) AS imprese, COUNT(*) AS aiuti, {rtot()} AS totale_esl, {mean()} AS media_esl,
         {_type_share('PMI')} AS quota_pmi_pct,
         {_type_share('Grande Impresa')} AS quota_grande_pct,
         {_type_share('Microimpresa')} AS quota_micro_pct
  FROM clean GROUP BY ALL HAVING regione <> 'ND')
SELECT *,
       ROUND(AVG(totale_esl) OVER nazione, 0) AS media_nazionale_esl,
       ROUND(STDDEV_SAMP(totale_esl) OVER nazione, 0) AS std_nazionale_esl,
       IF(totale_esl IS NULL, NULL, {rd('PERCENT_RANK() OVER (PARTITION BY anno ORDER BY totale_esl)', 4)}) AS percentile_esl
FROM per_luogo
WINDOW nazione AS (PARTITION BY anno)""")

MARTS["mart_policy"] = _q(WITH_CLEAN, f"""
SELECT anno, 'obiettivo' AS dimensione, cod_obiettivo AS codice, obiettivo AS descrizione,
       COUNT(*) AS aiuti, COUNT(DISTINCT {CF}) AS imprese, {rtot()} AS totale_esl, {mean()} AS media_esl,
       {share('anno')} AS quota_pct_su_anno
FROM clean WHERE cod_obiettivo IS NOT NULL AND cod_obiettivo != ''
GROUP BY anno, cod_obiettivo, obiettivo
UNION ALL
SELECT anno, 'strumento' AS dimensione, cod_strumento AS codice, strumento AS descrizione,
       COUNT(*) AS aiuti, COUNT(DISTINCT {CF}) AS imprese, {rtot()} AS totale_esl, {mean()} AS media_esl,
       {share('anno')} AS quota_pct_su_anno
FROM clean WHERE strumento IS NOT NULL AND strumento != ''
GROUP BY anno, cod_strumento, strumento""")

MARTS["mart_top"] = _q(WITH_CLEAN, f"""
(SELECT 'beneficiario' AS dimensione, {CF} AS codice, denominazione_beneficiario AS descrizione,
        regione_beneficiario AS regione, COUNT(*) AS aiuti, {rtot()} AS totale_esl, {mean()} AS media_esl
 FROM clean GROUP BY ALL HAVING codice <> '' AND descrizione <> ''
 ORDER BY totale_esl DESC, codice, descrizione, regione LIMIT 1000)
UNION ALL BY NAME
SELECT 'procedimento' AS dimensione, cod_procedimento AS codice, procedimento AS descrizione,
       COUNT(*) AS aiuti, {rtot()} AS totale_esl
FROM clean GROUP BY ALL HAVING codice <> ''""")

_P, _A = "importo_prestiti_garantiti", "importo_aiuto_ad_hoc"
MARTS["mart_misure_per_tipo"] = _q(WITH_MEASURES, f"""
SELECT des_tipo_misura, COUNT(*) AS n_misure,
       {rtot(_P)} AS prestiti_garantiti_eur, {rtot(_A)} AS aiuto_ad_hoc_eur,
       CAST(ROUND({tot(_P)} + {tot(_A)}, 0) AS DOUBLE) AS totale_eur
FROM measures WHERE des_tipo_misura IS NOT NULL
GROUP BY des_tipo_misura""")
MARTS["mart_misure_attive"] = _q(WITH_MEASURES, f"""
SELECT anno, COUNT(*) AS n_misure_istituite,
       CAST(SUM(CASE WHEN {_active()} THEN 1 ELSE 0 END) AS BIGINT) AS ancora_attive,
       {pct(f"SUM(CASE WHEN {_active()} THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS quota_attive_pct
FROM measures WHERE anno IS NOT NULL
GROUP BY anno""")
MARTS["mart_top_misure"] = _q(WITH_MEASURES, f"""
SELECT car, titolo_misura, des_tipo_misura, des_autorita, autorita_concedente, data_inizio_misura,
       CAST(ROUND(CAST({_P} AS DECIMAL(28,8)), 0) AS DOUBLE) AS prestiti_garantiti_eur,
       CAST(ROUND(CAST({_A} AS DECIMAL(28,8)), 0) AS DOUBLE) AS aiuto_ad_hoc_eur,
       CAST(ROUND(CAST({_P} AS DECIMAL(28,8)) + CAST({_A} AS DECIMAL(28,8)), 0) AS DOUBLE) AS totale_eur,
       CASE WHEN {_active()} THEN 'attiva' ELSE 'scaduta' END AS stato
FROM measures WHERE car IS NOT NULL""")


# ---------------------------------------------------------------- Q0-Q10
# Parameters of the registered analyst queries, shared with aidspark.queries.
from aidspark.queries import Q_TERM, Q_YEAR  # noqa: E402
_MEAN_RAW = f"CAST({tot()} AS DOUBLE) / NULLIF(COUNT({E}), 0)"
_HAS_CUP = "cup != '' AND cup != 'n.d.'"
_NO_CUP = "cup = '' OR cup = 'n.d.'"

ANALYSIS = {
    "q_total_by_region": _q(WITH_CLEAN, f"""
SELECT regione_beneficiario, {rtot()} AS totale FROM clean GROUP BY regione_beneficiario"""),
    "q_region_year": _q(WITH_RAW, f"""
SELECT anno, regione_beneficiario, {rtot()} AS totale_erogato, COUNT(DISTINCT {CF}) AS n_imprese
FROM raw GROUP BY anno, regione_beneficiario"""),
    "q_procedure_trend": _q(WITH_RAW, f"""
SELECT anno, procedimento, {rtot()} AS totale, COUNT(DISTINCT {CF}) AS n_beneficiari
FROM raw GROUP BY anno, procedimento"""),
    "q_find_company": _q(WITH_RAW, f"""
SELECT denominazione_beneficiario, {CF}, data_concessione, soggetto_concedente, titolo_misura,
       {rd(E, 2)} AS importo, procedimento, regione_beneficiario
FROM raw WHERE contains(denominazione_beneficiario, '{Q_TERM}')"""),
    "q_top_grantors": _q(WITH_RAW, f"""
SELECT soggetto_concedente, {rtot()} AS totale_erogato, COUNT(*) AS n_aiuti,
       COUNT(DISTINCT {CF}) AS n_imprese
FROM raw WHERE anno = {Q_YEAR} GROUP BY soggetto_concedente
ORDER BY totale_erogato DESC, soggetto_concedente LIMIT 10"""),
    "q_top_sectors": _q(WITH_RAW, f"""
SELECT settore_attivita, COUNT(DISTINCT {CF}) AS n_imprese, {rtot()} AS totale,
       {rd(_MEAN_RAW, 2)} AS importo_medio
FROM raw WHERE settore_attivita != '' AND {E} IS NOT NULL GROUP BY settore_attivita
ORDER BY totale DESC, settore_attivita LIMIT 20"""),
    "q_per_capita": _q(WITH_RAW, f""",
a AS (SELECT regione_beneficiario, {rtot()} AS totale_aiuti FROM raw WHERE anno = {Q_YEAR}
      GROUP BY regione_beneficiario),
p AS (SELECT regione, CAST(SUM(popolazione) AS BIGINT) AS residenti FROM ({S.POPULATION_SQL}) x
      WHERE anno = {Q_YEAR} GROUP BY regione)
SELECT a.regione_beneficiario, a.totale_aiuti, p.residenti,
       {rd('a.totale_aiuti / p.residenti', 2)} AS aiuto_procapite
FROM a JOIN p ON a.regione_beneficiario = p.regione"""),
    "q_cumulation": _q(WITH_RAW, f"""
SELECT {CF}, denominazione_beneficiario, COUNT(DISTINCT titolo_misura) AS n_misure_distinte,
       {rtot()} AS totale_complessivo
FROM raw WHERE anno = {Q_YEAR} GROUP BY {CF}, denominazione_beneficiario
HAVING COUNT(DISTINCT titolo_misura) > 5"""),
    "q_monthly_trend": _q(WITH_RAW, f"""
SELECT anno, mese, COUNT(*) AS n_aiuti, {rtot()} AS totale_mensile FROM raw GROUP BY anno, mese"""),
    "q_instrument_share": _q(WITH_RAW, f"""
SELECT strumento, COUNT(*) AS n, {rtot()} AS totale, {rd(_MEAN_RAW, 2)} AS importo_medio,
       {pct(tot(), f"SUM({tot()}) OVER ()", 1)} AS percentuale
FROM raw WHERE strumento != '' GROUP BY strumento"""),
    "q_cup_traceability": _q(WITH_RAW, f"""
SELECT anno,
       CAST(SUM(CASE WHEN {_HAS_CUP} THEN 1 ELSE 0 END) AS BIGINT) AS con_cup,
       CAST(SUM(CASE WHEN {_NO_CUP} THEN 1 ELSE 0 END) AS BIGINT) AS senza_cup,
       CAST(ROUND(SUM(CASE WHEN {_HAS_CUP} THEN CAST({E} AS DECIMAL(28,8)) ELSE 0 END), 0) AS DOUBLE)
         AS importo_con_cup,
       CAST(ROUND(SUM(CASE WHEN {_NO_CUP} THEN CAST({E} AS DECIMAL(28,8)) ELSE 0 END), 0) AS DOUBLE)
         AS importo_senza_cup
FROM raw GROUP BY anno"""),
}

# ---------------------------------------------------------------- J1-J5
WITH_CLEAN_MEASURES = f"{WITH_CLEAN},\nmeasures AS ({S.MEASURE_RAW_SQL})"
JOINS = {
    "join_aid_measure": _q(WITH_CLEAN_MEASURES, f""",
a AS (SELECT car, COUNT(*) AS aiuti, {tot()} AS erog FROM clean WHERE car != '' GROUP BY car),
m AS (SELECT car, COUNT(*) OVER (PARTITION BY car) AS n_finestre, titolo_misura, data_inizio_misura,
             CAST({_P} AS DECIMAL(28,8)) + CAST({_A} AS DECIMAL(28,8)) AS plafond,
             ROW_NUMBER() OVER (PARTITION BY car ORDER BY data_inizio_misura DESC) AS rn
      FROM measures WHERE car IS NOT NULL AND car != '')
SELECT a.car, a.aiuti, CAST(ROUND(a.erog, 0) AS DOUBLE) AS erogato_esl, m.titolo_misura,
       m.data_inizio_misura, m.n_finestre, CAST(ROUND(m.plafond, 0) AS DOUBLE) AS plafond_eur,
       {pct('a.erog', 'm.plafond', 2)} AS quota_erogata_pct
FROM a LEFT JOIN (SELECT * FROM m WHERE rn = 1) m ON a.car = m.car"""),
    "join_by_fiscal_code": _q(WITH_CLEAN, f""",
a AS (SELECT upper(trim({CF})) AS codice_fiscale, COUNT(*) AS aiuti, {tot()} AS t FROM clean
      WHERE upper(trim({CF})) != '' GROUP BY upper(trim({CF}))),
e AS (SELECT upper(trim(codice_fiscale)) AS codice_fiscale, COUNT(*) AS n_record_entita
      FROM ({S.ENTITIES_SQL}) x WHERE upper(trim(codice_fiscale)) != '' GROUP BY upper(trim(codice_fiscale)))
SELECT a.codice_fiscale, a.aiuti, CAST(ROUND(a.t, 0) AS DOUBLE) AS totale_esl, e.n_record_entita
FROM a JOIN e ON a.codice_fiscale = e.codice_fiscale"""),
    "join_by_cup_bridge": _q(WITH_CLEAN, f""",
br AS (SELECT DISTINCT cup, comune FROM ({S.CUP_BRIDGE_SQL}) x WHERE cup NOT IN ('', 'n.d.')),
pc AS (SELECT cup, COUNT(*) AS n, {tot()} AS t FROM clean
       WHERE cup IS NOT NULL AND cup NOT IN ('', 'n.d.') GROUP BY cup)
SELECT comune, COUNT(*) AS n_progetti, CAST(SUM(n) AS BIGINT) AS aiuti,
       CAST(ROUND(SUM(t), 0) AS DOUBLE) AS totale_esl
FROM pc JOIN br ON pc.cup = br.cup GROUP BY comune"""),
    "join_by_region": _q(WITH_CLEAN, f""",
t AS (SELECT DISTINCT regione, macro_area FROM ({S.TERRITORY_SQL}) x),
a AS (SELECT regione_beneficiario AS regione, COUNT(*) AS aiuti, {tot()} AS s FROM clean
      WHERE regione_beneficiario != 'ND' GROUP BY regione_beneficiario)
SELECT t.macro_area, a.regione, a.aiuti, CAST(ROUND(a.s, 0) AS DOUBLE) AS totale_esl
FROM a JOIN t ON a.regione = t.regione"""),
}


# ---------------------------------------------------------------- XML ingest
from aidspark.queries import FILE_YEARS  # noqa: E402
from aidspark.schemas import MEASURE_COLUMNS  # noqa: E402
from aidspark.sources import xml_standin as XS  # noqa: E402

_AID_OUT = ", ".join(AID_COLUMNS)
INGEST = {
    "ingest_aid_xml": f"SELECT {_AID_OUT} FROM ({XS.AID_XML_FLAT_SQL}) t WHERE anno != 0",
    "flatten_aid": f"SELECT {_AID_OUT} FROM ({XS.AID_XML_FLAT_SQL}) t",
    "reject_invalid_year": f"SELECT {_AID_OUT} FROM ({XS.AID_XML_FLAT_SQL}) t WHERE anno = 0",
    "quarantine_malformed": f"""SELECT fonte, CAST(SUM(1 - bad) AS BIGINT) AS record_ok,
       CAST(SUM(bad) AS BIGINT) AS record_scartati FROM ({XS.AID_XML_RECORDS_SQL}) t GROUP BY fonte""",
    "select_files_by_year": f"""SELECT {_AID_OUT} FROM ({XS.AID_XML_FLAT_SQL}) t
WHERE anno != 0 AND _file_year BETWEEN {FILE_YEARS[0]} AND {FILE_YEARS[1]}""",
    "ingest_measure_xml": f"SELECT * FROM ({S.MEASURE_RAW_SQL}) t WHERE anno != 0",
    "flatten_measure": f"SELECT * FROM ({S.MEASURE_RAW_SQL}) t",
    "conform_schema": "SELECT " + ", ".join(
        "CAST(NULL AS VARCHAR) AS link_aiuto" if c == "link_aiuto" else c for c in MEASURE_COLUMNS)
        + f" FROM ({S.MEASURE_RAW_SQL}) t",
}


# ---------------------------------------------------------------- value functions
from aidspark.sources import text_standin as TS  # noqa: E402

# RE2 has no look-ahead: consume the following character and put it back.
_WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_INT_RE = "[+-]?[0-9](_?[0-9])*"
_FLOAT_RE = r"[+-]?(([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?)|(\.[0-9](_?[0-9])*))([eE][+-]?[0-9](_?[0-9])*)?"


def _norm_sql(x: str) -> str:
    return f"COALESCE(trim(regexp_replace({x}, '{_WS}', ' ', 'g')), '')"


def _vals(kind: str, outs: str) -> str:
    return f"WITH v AS ({TS.text_values_sql(kind)})\nSELECT l_orderkey, l_linenumber, testo, {outs} FROM v"


_AMT = f"replace({_norm_sql('testo')}, ',', '.')"
_P0, _P1 = "trim(split_part(testo, '-', 1))", "trim(split_part(testo, '-', 2))"
_YM_OK = (f"(testo != '' AND regexp_full_match({_P0}, '{_INT_RE}') AND "
          f"(len(string_split(testo, '-')) < 2 OR regexp_full_match({_P1}, '{_INT_RE}')))")
VALUES = {
    "scrub_control_chars": _vals("control", r"regexp_replace(testo, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS pulito"),
    "repair_truncated_tags": _vals("tag", "regexp_replace(regexp_replace(testo, "
                                   "'BASE_GIURIDICA_NAZ([^A-Z_]|$)', 'BASE_GIURIDICA_NAZIONALE\\1', 'g'), "
                                   "'IMPORTO_NOMIN([^A-Z_]|$)', 'IMPORTO_NOMINALE\\1', 'g') AS pulito"),
    "normalize_text": _vals("space", f"{_norm_sql('testo')} AS pulito"),
    "parse_amount": _vals("amount", f"CASE WHEN {_AMT} != '' AND (regexp_full_match({_AMT}, '{_FLOAT_RE}') "
                                    f"OR regexp_full_match(lower({_AMT}), '[+-]?(nan|inf|infinity)')) "
                                    f"THEN TRY_CAST(replace({_AMT}, '_', '') AS DOUBLE) END AS importo"),
    "year_month": _vals("date", f"CASE WHEN {_YM_OK} THEN CAST(replace({_P0}, '_', '') AS INT) ELSE 0 END AS anno, "
                                f"CASE WHEN {_YM_OK} AND len(string_split(testo, '-')) >= 2 "
                                f"THEN CAST(replace({_P1}, '_', '') AS INT) ELSE 0 END AS mese"),
}


# ---------------------------------------------------------------- storage
from aidspark.queries import (OVERWRITE_YEARS, READ_YEAR, REBUILD_YEARS,  # noqa: E402
                              UPSERT_FROM_YEAR, UPSERT_LAST_MONTH)
from aidspark.operators.marts import AID_MARTS  # noqa: E402


def _dedup_sql(where: str = "TRUE", cols: str = _AID_OUT) -> str:
    return (f"SELECT {cols} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cor, id_componente, "
            f"cod_strumento ORDER BY {S.ARRIVAL_DESC_SQL}) AS rn FROM ({S.AID_RAW_ARRIVAL_SQL}) a "
            f"WHERE {where}) d WHERE rn = 1")


def _with_col(col: str, expr: str) -> str:
    return ", ".join(f"{expr} AS {c}" if c == col else c for c in AID_COLUMNS)


_YRS = ", ".join(str(y) for y in OVERWRITE_YEARS)
_AGG = _with_col("soggetto_concedente", "soggetto_concedente || ' (agg.)'")
STORAGE = {
    "dedup_keep_last": _dedup_sql(),
    "write_year_overwrite": f"""SELECT {_AID_OUT} FROM ({S.AID_RAW_SQL}) r WHERE anno NOT IN ({_YRS})
UNION ALL {_dedup_sql(f"anno IN ({_YRS})")}""",
    "upsert_append": f"""SELECT {_AID_OUT} FROM ({S.AID_RAW_SQL}) r WHERE anno < {UPSERT_FROM_YEAR}
UNION ALL {_dedup_sql(f"anno > {UPSERT_FROM_YEAR}", _AGG)}
UNION ALL {_dedup_sql(f"anno = {UPSERT_FROM_YEAR} AND mese <= {UPSERT_LAST_MONTH}", _AGG)}
UNION ALL {_dedup_sql(f"anno = {UPSERT_FROM_YEAR} AND (cor, id_componente, cod_strumento) NOT IN "
                      f"(SELECT (cor, id_componente, cod_strumento) FROM ({S.AID_RAW_SQL}) n "
                      f"WHERE anno = {UPSERT_FROM_YEAR} AND mese <= {UPSERT_LAST_MONTH})")}""",
    "rebuild_years": f"""SELECT {_with_col("soggetto_concedente", "soggetto_concedente || ' (vecchio)'")}
FROM ({S.AID_RAW_SQL}) r WHERE anno NOT BETWEEN {REBUILD_YEARS[0]} AND {REBUILD_YEARS[1]}
UNION ALL SELECT {_AID_OUT} FROM ({XS.AID_XML_FLAT_SQL}) t
WHERE anno BETWEEN {REBUILD_YEARS[0]} AND {REBUILD_YEARS[1]}""",
    "rebuild_measures": f"SELECT * FROM ({S.MEASURE_RAW_SQL}) t WHERE anno != 0",
    "read_year": f"SELECT * FROM ({S.AID_RAW_SQL}) r WHERE anno = {READ_YEAR}",
    "read_all_years": f"""SELECT *, CASE WHEN anno >= {UPSERT_FROM_YEAR} THEN 'lotto2' END AS fonte
FROM ({S.AID_RAW_SQL}) r""",
    "publish_layers": "\nUNION ALL\n".join(
        [f"SELECT 'clean' AS layer, 'aiuti_stato' AS tabella, COUNT(*) AS righe FROM ({MARTS['clean_aid']}) t"]
        + [f"SELECT 'mart', '{n}', COUNT(*) FROM ({MARTS[n]}) t" for n in AID_MARTS]),
}


# ---------------------------------------------------------------- quality and catalog
from aidspark.operators import quality as QR  # noqa: E402
from aidspark.queries import INDEX_FROM_YEAR, STANDIN_COVERAGE  # noqa: E402

_MEAS = f"({S.MEASURE_RAW_SQL})"


def _min_rows(name: str, body: str, n: int) -> str:
    return (f"SELECT '{name}' AS tabella, COUNT(*) AS righe, CAST({n} AS BIGINT) AS minimo, "
            f"COUNT(*) >= {n} AS esito FROM ({body}) t")


def _not_null(name: str, body: str, cols) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS tabella, '{c}' AS colonna, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
        f"AS nulli, SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = 0 AS esito FROM ({body}) t" for c in cols)


def _manifest(body: str, origin: str | None = None) -> str:
    first, last, last_m = STANDIN_COVERAGE
    exp = f"(CASE WHEN anno < {first} OR anno > {last} THEN 0 WHEN anno = {last} THEN {last_m} ELSE 12 END)"
    months = "list_distinct(list(mese) FILTER (WHERE mese BETWEEN 1 AND 12))"
    tag = f", '{origin}' AS origine" if origin else ""
    return f"""SELECT anno, COUNT(*) AS righe, array_to_string(list_sort({months}), ',') AS mesi,
       CAST(len({months}) AS BIGINT) AS n_mesi, {exp} AS mesi_attesi,
       CASE WHEN {exp} = 0 THEN CAST(0 AS DOUBLE)
            ELSE least(CAST(1 AS DOUBLE), round_even(len({months}) / {exp}, 2)) END AS completezza{tag}
FROM ({body}) t GROUP BY anno"""


_CLEAN_SQL = MARTS["clean_aid"]
_RAW_SQL = f"{WITH_RAW} SELECT * FROM raw"
_CLEAN_NN = QR.AID_CLEAN_RULES["not_null"]
_CLEAN_MIN = QR.AID_CLEAN_RULES["min_rows"]
_CLEAN_PASSED = " + ".join([f"CASE WHEN COUNT(*) >= {_CLEAN_MIN} THEN 1 ELSE 0 END"] + [
    f"CASE WHEN SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = 0 THEN 1 ELSE 0 END" for c in _CLEAN_NN])
_REGISTERED = ["mart_per_regione", "mart_per_procedimento", "mart_top_beneficiari", "mart_per_obiettivo",
               "mart_per_strumento", "mart_tipo_beneficiario", "mart_settore_regione"]
_MART_COUNTS = " + ".join(f"(SELECT COUNT(*) FROM ({MARTS[fn]}) t)" for fn in _REGISTERED)
_OBJ = MARTS["mart_per_obiettivo"]


def _signal(layer, rows, checks, passed):
    return (f"SELECT '{layer}' AS layer, CAST({rows} AS BIGINT) AS righe, CAST({checks} AS BIGINT) AS controlli, "
            f"CAST({passed} AS BIGINT) AS superati, CASE WHEN {checks} = 0 THEN 100 ELSE "
            f"CAST(floor(({passed}) * 100.0 / {checks}) AS INTEGER) END AS punteggio_qualita, "
            f"CASE WHEN ({passed}) = {checks} THEN 'SUCCESS' ELSE 'WARNING' END AS stato")


_PUBLISHED = dict(zip(["mart_aiuti_per_regione", "mart_aiuti_per_procedimento", "mart_aiuti_top_beneficiari",
                       "mart_aiuti_per_obiettivo", "mart_aiuti_per_strumento", "mart_aiuti_tipo_beneficiario",
                       "mart_aiuti_settore_regione"], _REGISTERED))


_TOP = "mart_top_beneficiari"  # of a year: the top of that year alone


QUALITY = {
    "dq_min_rows": "\nUNION ALL\n".join(
        [_min_rows("aiuti_stato.clean", _CLEAN_SQL, _CLEAN_MIN),
         _min_rows("misure.clean", f"SELECT * FROM {_MEAS} m", QR.MEASURE_CLEAN_RULES["min_rows"]),
         _min_rows("mart_aiuti_per_obiettivo", _OBJ, 10)]
        + [_min_rows(n, MARTS[n], QR.MEASURE_MART_RULES[n]["min_rows"]) for n in
           ("mart_misure_per_tipo", "mart_misure_attive", "mart_top_misure")]),
    "dq_not_null": _not_null("aiuti_stato.clean", _CLEAN_SQL, _CLEAN_NN) + "\nUNION ALL\n"
                   + _not_null("misure.clean", f"SELECT * FROM {_MEAS} m", QR.MEASURE_CLEAN_RULES["not_null"]),
    "dq_primary_key": f"""SELECT 'aiuti.raw' AS tabella, concat_ws('|', cor, id_componente, cod_strumento) AS chiave,
       COUNT(*) AS occorrenze FROM ({_RAW_SQL}) t GROUP BY ALL HAVING COUNT(*) > 1
UNION ALL SELECT 'misure.clean', concat_ws('|', car, data_inizio_misura), COUNT(*) FROM ({_MEAS}) m
GROUP BY ALL HAVING COUNT(*) > 1""",
    "run_signal": "\nUNION ALL\n".join([
        f"SELECT * FROM ({_signal('raw', f'(SELECT COUNT(*) FROM ({_RAW_SQL}) t)', 0, 0)})",
        f"SELECT * FROM ({_signal('clean', 'COUNT(*)', 2 + len(_CLEAN_NN), _CLEAN_PASSED + ' + 1')} FROM ({_CLEAN_SQL}) t)",
        f"SELECT * FROM ({_signal('mart', _MART_COUNTS, 3, f'(SELECT CASE WHEN COUNT(*) >= 10 THEN 1 ELSE 0 END FROM ({_OBJ}) o) + 2')})",
    ]),
    "manifest_by_year": _manifest(_RAW_SQL),
    "manifest_index": _manifest(_dedup_sql(f"anno >= {INDEX_FROM_YEAR}"), "corrente") + "\nUNION ALL\n"
                      + f"SELECT * FROM ({_manifest(_RAW_SQL, 'precedente')}) p WHERE anno < {INDEX_FROM_YEAR}",
    "manifest_totals": f"""SELECT COUNT(*) AS anni, CAST(SUM(righe) AS BIGINT) AS righe_totali FROM (
{_manifest(_dedup_sql(f"anno >= {INDEX_FROM_YEAR}"), "corrente")} UNION ALL
SELECT * FROM ({_manifest(_RAW_SQL, "precedente")}) p WHERE anno < {INDEX_FROM_YEAR}) i""",
    "publish_years": "\nUNION ALL\n".join(
        [f"SELECT anno, 'clean' AS layer, 'clean' AS tabella, COUNT(*) AS righe FROM ({_CLEAN_SQL}) t GROUP BY anno"]
        + [f"SELECT anno, 'mart', '{n}', COUNT(*) FROM ({MARTS[k]}) t GROUP BY anno" for n, k in _PUBLISHED.items() if k != _TOP]
        + [f"SELECT anno, 'mart', '{n}', least(1000, COUNT(DISTINCT (codice_fiscale_beneficiario, denominazione_beneficiario, "
           f"regione_beneficiario))) FROM ({_CLEAN_SQL}) t WHERE codice_fiscale_beneficiario != '' GROUP BY anno"
           for n, k in _PUBLISHED.items() if k == _TOP]),
    "manifest_measures": f"SELECT COUNT(*) AS righe, CAST(20 AS BIGINT) AS campi FROM {_MEAS} m",
    "file_summary": f"SELECT anno, COUNT(*) AS righe FROM ({_RAW_SQL}) t GROUP BY ROLLUP (anno)",
}


_ARR_DESC = ", ".join(f"_a{i} DESC" for i in range(len(S.ARRIVAL_COLS)))
STREAMING = {
    "incremental_load": f"""SELECT {_AID_OUT} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY cor, id_componente, cod_strumento ORDER BY {_ARR_DESC}) AS rn
  FROM ({XS.AID_XML_ARRIVAL_SQL}) t) d WHERE rn = 1""",
}


# ---------------------------------------------------------------- joinable columns
from aidspark.operators import lattice as LT  # noqa: E402
from aidspark.queries import JOINABLE_LEAST  # noqa: E402

_KEY_COLUMNS = {
    "aiuti": (f"SELECT * FROM ({_RAW_SQL}) x", [c for c in AID_COLUMNS if c not in ("elemento_aiuto", "importo_nominale")]),
    "misure": (f"SELECT * FROM {_MEAS} x", [c for c in MEASURE_COLUMNS if not c.startswith("importo_")]),
    "enti": (S.ENTITIES_SQL, ["codice_fiscale", "event_type"]),
    "ponte_cup": (S.CUP_BRIDGE_SQL, ["cup", "comune"]),
    "territorio": (S.TERRITORY_SQL, ["regione", "macro_area"]),
}
_JOINABLE_SQL = ("WITH vals AS (" + "\nUNION ALL\n".join(
    f"SELECT DISTINCT {i} AS k, '{d}' AS d, '{d}.{c}' AS c, trim(CAST({c} AS VARCHAR)) AS v FROM ({body}) t "
    f"WHERE {c} IS NOT NULL AND trim(CAST({c} AS VARCHAR)) != ''"
    for i, (d, body, c) in enumerate((d, body, c) for d, (body, cols) in _KEY_COLUMNS.items() for c in cols)) + f"""),
n AS (SELECT c, COUNT(*) AS n FROM vals GROUP BY c),
met AS (SELECT a.c AS ca, b.c AS cb, COUNT(*) AS comuni FROM vals a JOIN vals b ON a.v = b.v AND a.d != b.d AND a.k < b.k GROUP BY ALL)
SELECT ca AS colonna_a, cb AS colonna_b, x.n AS distinti_a, y.n AS distinti_b, comuni,
       CAST(ROUND(comuni / least(x.n, y.n), 4) AS DOUBLE) AS contenimento
FROM met JOIN n x ON x.c = ca JOIN n y ON y.c = cb WHERE comuni >= {JOINABLE_LEAST} * least(x.n, y.n)""")


# ---------------------------------------------------------------- versioned tables, salvage, bitmaps
FIRM_LEVELS = ("anno, regione_beneficiario, procedimento", "anno, regione_beneficiario", "anno", "regione_beneficiario", "")
SAME_RESULT = {"versioned_overwrite": STORAGE["write_year_overwrite"], "versioned_upsert": STORAGE["upsert_append"],
               "versioned_rebuild": STORAGE["rebuild_years"], "versioned_incremental_load": STREAMING["incremental_load"],
               "ingest_prefixed_xml": INGEST["ingest_aid_xml"]}
LATER = SAME_RESULT | {
    "mart_base": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS insieme, COUNT(*) AS gruppi, CAST(SUM(n) AS BIGINT) AS aiuti, CAST(SUM(c) AS BIGINT) AS importi, "
        f"CAST(ROUND(SUM(t), 0) AS DOUBLE) AS totale_esl FROM (SELECT {', '.join(cols)}, COUNT(*) AS n, COUNT(elemento_aiuto) AS c, "
        f"SUM(CAST(elemento_aiuto AS DECIMAL(28,8))) AS t FROM (SELECT *, CASE WHEN settore_attivita LIKE '(NACE 2) _.%' AND "
        f"substr(settore_attivita, 10, 1) BETWEEN 'A' AND 'S' THEN substr(settore_attivita, 10, 1) END AS sezione "
        f"FROM ({_CLEAN_SQL}) x) y GROUP BY {', '.join(cols)}) z" for name, cols in LT.SETS.items()),
    "manifest_refresh": _manifest(STORAGE["write_year_overwrite"]),
    "join_by_fiscal_code_prefiltered": JOINS["join_by_fiscal_code"],
    "join_by_cup_bridge_prefiltered": JOINS["join_by_cup_bridge"],
    "bucketed_dedup": STORAGE["dedup_keep_last"],
    "joinable_pairs": _JOINABLE_SQL,
    "footer_counts": f"SELECT anno, COUNT(*) AS righe FROM ({_RAW_SQL}) t GROUP BY anno",
    "salvage_malformed": f"SELECT {_AID_OUT} FROM ({XS.AID_XML_SALVAGED_SQL}) t WHERE anno != 0",
    "distinct_firms": "\nUNION ALL\n".join(
        "SELECT " + ", ".join(c if c in level.split(", ") else f"CAST(NULL AS {kind}) AS {c}" for c, kind in (
            ("anno", "INTEGER"), ("regione_beneficiario", "VARCHAR"), ("procedimento", "VARCHAR")))
        + f", '{level.replace(', ', ',')}' AS livello, COUNT(DISTINCT codice_fiscale_beneficiario) AS imprese FROM ({_RAW_SQL}) t"
        + (f" GROUP BY {level}" if level else "") for level in FIRM_LEVELS),
}


def oracle_sql() -> dict[str, str]:
    out = dict(MARTS)
    out.update(INGEST)
    out.update(VALUES)
    out.update(STORAGE)
    out.update(QUALITY)
    out.update(STREAMING)
    out.update(ANALYSIS)
    out.update(JOINS)
    out.update(LATER)
    return out
