"""Data-quality gates (V1-V7). Each gate returns a DataFrame of findings.

Row-level gates are aggregates: minimum rows and NULL counts of every checked
column come from one pass (one aggregate with one conditional sum per column);
key uniqueness is a grouped count with partial aggregation, so a hot key costs
one row per partition in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from aidspark.schemas import MEASURE_COLUMNS

# --- fixed values: gate thresholds of the register configuration -------------
AID_CLEAN_RULES = {"required_columns": ["anno", "elemento_aiuto", "regione_beneficiario",
                                        "codice_fiscale_beneficiario"],
                   "min_rows": 100000,
                   "not_null": ["anno", "elemento_aiuto", "codice_fiscale_beneficiario"]}
AID_REQUIRED_MARTS = ["mart_aiuti_per_regione", "mart_aiuti_per_obiettivo"]
AID_MART_RULES = {"mart_aiuti_per_obiettivo": {"min_rows": 10}}
MEASURE_CLEAN_RULES = {"required_columns": MEASURE_COLUMNS, "min_rows": 10000, "not_null": ["anno"],
                       "primary_key": ["car", "data_inizio_misura"]}
MEASURE_REQUIRED_MARTS = ["mart_misure_per_tipo", "mart_top_misure"]
MEASURE_MART_RULES = {
    "mart_misure_per_tipo": {"required_columns": ["des_tipo_misura", "n_misure", "prestiti_garantiti_eur",
                                                  "aiuto_ad_hoc_eur", "totale_eur"],
                             "primary_key": ["des_tipo_misura"], "min_rows": 3},
    "mart_misure_attive": {"required_columns": ["anno", "n_misure_istituite", "ancora_attive",
                                                "quota_attive_pct"],
                           "primary_key": ["anno"], "min_rows": 10},
    "mart_top_misure": {"required_columns": ["car", "titolo_misura", "des_tipo_misura", "totale_eur", "stato"],
                        "primary_key": ["car", "data_inizio_misura"], "min_rows": 10000},
}


class QualityError(RuntimeError):
    pass


def dq_required_columns(spark: SparkSession, df: DataFrame, required: Sequence[str],
                        table: str) -> DataFrame:
    """V1: one row per required column, present or not (schema only, no scan)."""
    have = set(df.columns)
    schema = StructType([StructField("tabella", StringType()), StructField("colonna", StringType()),
                         StructField("presente", BooleanType())])
    return spark.createDataFrame([(table, c, c in have) for c in required], schema)


def dq_rows_and_nulls(df: DataFrame, not_null: Sequence[str], table: str) -> DataFrame:
    """V2 + V3 in one pass: row count and NULL count per checked column,
    returned as one row per column (``colonna`` = '*' for the row count)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}")
             for i, c in enumerate(not_null)]
    a = df.agg(*aggs)
    pairs = ", ".join([f"'*', _rows"] + [f"'{c}', _n{i}" for i, c in enumerate(not_null)])
    return a.selectExpr(f"'{table}' AS tabella", f"stack({len(not_null) + 1}, {pairs}) AS (colonna, valore)")


def dq_min_rows(df: DataFrame, min_rows: int, table: str) -> DataFrame:
    """V2: (tabella, righe, minimo, esito)."""
    return df.agg(F.count(F.lit(1)).alias("righe")).select(
        F.lit(table).alias("tabella"), "righe", F.lit(min_rows).cast("bigint").alias("minimo"),
        (F.col("righe") >= min_rows).alias("esito"))


def dq_not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """V3: (tabella, colonna, nulli, esito), one scan for all columns."""
    r = dq_rows_and_nulls(df, columns, table).where(F.col("colonna") != "*")
    return r.select("tabella", "colonna", F.col("valore").alias("nulli"), (F.col("valore") == 0).alias("esito"))


def dq_primary_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """V4: key values that occur more than once, with their count."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("occorrenze"))
            .where(F.col("occorrenze") > 1))


def dq_required_tables(spark: SparkSession, present: Sequence[str], required: Sequence[str]) -> DataFrame:
    """V5: one row per required table, present or not."""
    have = set(present)
    schema = StructType([StructField("tabella", StringType()), StructField("presente", BooleanType())])
    return spark.createDataFrame([(t, t in have) for t in required], schema)


def enforce(findings: DataFrame, ok_col: str = "esito", fail_on_error: bool = True) -> DataFrame:
    """V6: raise when any finding failed and ``fail_on_error`` is set.
    Only the small findings table is inspected on the driver."""
    if fail_on_error:
        bad = findings.where(~F.coalesce(F.col(ok_col), F.lit(False)))  # no verdict is a failure
        n = bad.count()
        if n:
            raise QualityError(f"{n} failed check(s), e.g. {bad.first().asDict()}")
    return findings
