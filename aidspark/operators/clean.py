"""Clean layer (C1, C2) and schema conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aidspark.schemas import AID_COLUMNS, AID_SCHEMA, MEASURE_SCHEMA

MISSING_REGION = "ND"


def conform_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in schema order and type; absent ones as typed NULL; extras dropped."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def clean_aid(raw: DataFrame) -> DataFrame:
    """Region ''/NULL -> 'ND'; keep rows with an aid amount. Narrow (no shuffle)."""
    raw = conform_schema(raw, AID_SCHEMA)
    region = F.coalesce(F.nullif(F.col("regione_beneficiario"), F.lit("")), F.lit(MISSING_REGION))
    cols = [region.alias(c) if c == "regione_beneficiario" else F.col(c) for c in AID_COLUMNS]
    return raw.where(F.col("elemento_aiuto").isNotNull()).select(*cols)


def clean_measure(raw: DataFrame) -> DataFrame:
    """Identity over the fixed measure schema."""
    return conform_schema(raw, MEASURE_SCHEMA)
