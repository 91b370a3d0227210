"""Schemas: the single declaration of every layer's columns and types.

Fixed values: column names, source tag names and the keys below must equal the
published register layout, so they are listed plainly and in source order.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StringType,
                               StructField, StructType)

# --- fixed values: aid record, grant level (source tag -> column) -------------
GRANT_FIELDS = [
    ("DATA_CONCESSIONE", "data_concessione"),
    ("CAR", "car"),
    ("COR", "cor"),
    ("DENOMINAZIONE_BENEFICIARIO", "denominazione_beneficiario"),
    ("CODICE_FISCALE_BENEFICIARIO", "codice_fiscale_beneficiario"),
    ("DES_TIPO_BENEFICIARIO", "tipo_beneficiario"),
    ("REGIONE_BENEFICIARIO", "regione_beneficiario"),
    ("SOGGETTO_CONCEDENTE", "soggetto_concedente"),
    ("TITOLO_MISURA", "titolo_misura"),
    ("DES_TIPO_MISURA", "des_tipo_misura"),
    ("TITOLO_PROGETTO", "titolo_progetto"),
    ("DESCRIZIONE_PROGETTO", "descrizione_progetto"),
    ("CUP", "cup"),
    ("ATTO_CONCESSIONE", "atto_concessione"),
    ("BASE_GIURIDICA_NAZIONALE", "base_giuridica_nazionale"),
    ("IDENTIFICATIVO_UFFICIO", "identificativo_ufficio"),
    ("LINK_TRASPARENZA_NAZIONALE", "link_trasparenza_nazionale"),
]
# --- fixed values: aid record, component level ---------------------------------
COMPONENT_FIELDS = [
    ("ID_COMPONENTE_AIUTO", "id_componente"),
    ("DES_PROCEDIMENTO", "procedimento"),
    ("COD_PROCEDIMENTO", "cod_procedimento"),
    ("DES_REGOLAMENTO", "regolamento_ue"),
    ("COD_REGOLAMENTO", "cod_regolamento"),
    ("DES_OBIETTIVO", "obiettivo"),
    ("COD_OBIETTIVO", "cod_obiettivo"),
    ("SETTORE_ATTIVITA", "settore_attivita"),
]
# --- fixed values: aid record, instrument level (last two are amounts) ---------
INSTRUMENT_TEXT_FIELDS = [
    ("COD_STRUMENTO", "cod_strumento"),
    ("DES_STRUMENTO", "strumento"),
]
INSTRUMENT_AMOUNT_FIELDS = [
    ("ELEMENTO_DI_AIUTO", "elemento_aiuto"),
    ("IMPORTO_NOMINALE", "importo_nominale"),
]
# --- fixed values: measure record (source tag -> column, kind) -----------------
MEASURE_FIELDS = [
    ("CAR", "car", "text"),
    ("CAR_PADRE", "car_padre", "text"),
    ("CAR_ATTIVO", "car_attivo", "text"),
    ("TITOLO_MISURA", "titolo_misura", "text"),
    ("DES_TIPO_MISURA", "des_tipo_misura", "text"),
    ("COD_TIPO_MISURA", "cod_tipo_misura", "text"),
    ("DATA_INIZIO_MISURA", "data_inizio_misura", "text"),
    ("DATA_FINE_MISURA", "data_fine_misura", "text"),
    ("BASE_GIURIDICA_NAZIONALE", "base_giuridica_nazionale", "text"),
    ("STATO_MEMBRO", "stato_membro", "text"),
    ("COD_AMM", "cod_amm", "text"),
    ("DES_AUTORITA", "des_autorita", "text"),
    ("AUTORITA_CONCEDENTE_TRASP_CE", "autorita_concedente", "text"),
    ("IMPORTO_PRESTITI_GARANTITI", "importo_prestiti_garantiti", "amount"),
    ("IMPORTO_AIUTO_AD_HOC", "importo_aiuto_ad_hoc", "amount"),
    ("LINK_AIUTO", "link_aiuto", "text"),
    ("FLAG_QUADRO", "flag_quadro", "text"),
    ("FLAG_MODIFICA_REGIME_O_ESISTENTE", "flag_modifica_regime", "text"),
]
# --- fixed values: record tags, namespaces and keys ---------------------------
AID_RECORD_TAG = "AIUTO"
MEASURE_RECORD_TAG = "MISURA"
AID_DEDUP_KEY = ("cor", "id_componente", "cod_strumento")
MEASURE_KEY = ("car", "data_inizio_misura")
YEAR_COL, MONTH_COL = "anno", "mese"


def _flat(pairs, amount_cols=()):
    fields = []
    for _tag, name in pairs:
        fields.append(StructField(name, DoubleType() if name in amount_cols else StringType()))
    return fields


AID_SCHEMA = StructType(
    _flat(GRANT_FIELDS)
    + _flat(COMPONENT_FIELDS)
    + _flat(INSTRUMENT_TEXT_FIELDS)
    + [StructField(n, DoubleType()) for _t, n in INSTRUMENT_AMOUNT_FIELDS]
    + [StructField(YEAR_COL, IntegerType()), StructField(MONTH_COL, IntegerType())]
)
AID_COLUMNS = [f.name for f in AID_SCHEMA]

MEASURE_SCHEMA = StructType(
    [StructField(n, DoubleType() if kind == "amount" else StringType()) for _t, n, kind in MEASURE_FIELDS]
    + [StructField(YEAR_COL, IntegerType()), StructField(MONTH_COL, IntegerType())]
)
MEASURE_COLUMNS = [f.name for f in MEASURE_SCHEMA]


# Every leaf is read as an array of text: numbers and dates are parsed by our
# expressions (so the missing/bad-value rules are ours, not the XML reader's),
# and when a tag repeats the first occurrence wins, as in the source parser.
LEAF = ArrayType(StringType())


def _text_struct(tags):
    return StructType([StructField(t, LEAF) for t in tags])


# Parse schema for one <AIUTO> record. Containers are arrays so that repeated
# containers and repeated children are all kept.
INSTRUMENT_XML = _text_struct([t for t, _ in INSTRUMENT_TEXT_FIELDS + INSTRUMENT_AMOUNT_FIELDS])
COMPONENT_XML = StructType(
    [StructField(t, LEAF) for t, _ in COMPONENT_FIELDS]
    + [StructField("STRUMENTI_AIUTO", ArrayType(StructType([
        StructField("STRUMENTO_AIUTO", ArrayType(INSTRUMENT_XML))])))]
)
AID_XML_SCHEMA = StructType(
    [StructField(t, LEAF) for t, _ in GRANT_FIELDS]
    + [StructField("COMPONENTI_AIUTO", ArrayType(StructType([
        StructField("COMPONENTE_AIUTO", ArrayType(COMPONENT_XML))])))]
)
MEASURE_XML_SCHEMA = _text_struct([t for t, _n, _k in MEASURE_FIELDS])
CORRUPT_COL = "_corrupt_record"
