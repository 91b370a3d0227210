"""Temp views for ad-hoc Spark SQL over the layers.

The register's SQL reads ``raw_input`` (raw layer), ``clean_input`` (clean
layer) and, in the analyst notes, one view over all years. ``register_views``
binds the same names, so such SQL runs through ``spark.sql`` unchanged in
meaning; Catalyst prunes the year partitions and columns it does not need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aidspark.operators.clean import clean_aid, clean_measure
from aidspark.plans.storage import read_all_years

RAW_VIEW, CLEAN_VIEW, ALL_YEARS_VIEW = "raw_input", "clean_input", "aiuti"
MEASURE_RAW_VIEW, MEASURE_CLEAN_VIEW = "misure_raw_input", "misure_clean_input"


def register_views(spark: SparkSession, raw_path: str | None = None, raw: DataFrame | None = None,
                   measures: DataFrame | None = None, all_years_view: str = ALL_YEARS_VIEW) -> dict:
    """Bind ``raw_input``, ``clean_input`` and the all-years view (default
    ``aiuti``) to an aid raw layer (a path, read united by name, or a DataFrame);
    optionally the measure views. Returns the names bound."""
    if raw is None:
        raw = read_all_years(spark, raw_path)
    raw.createOrReplaceTempView(RAW_VIEW)
    raw.createOrReplaceTempView(all_years_view)
    clean_aid(raw).createOrReplaceTempView(CLEAN_VIEW)
    names = {"raw": RAW_VIEW, "clean": CLEAN_VIEW, "all_years": all_years_view}
    if measures is not None:
        measures.createOrReplaceTempView(MEASURE_RAW_VIEW)
        clean_measure(measures).createOrReplaceTempView(MEASURE_CLEAN_VIEW)
        names.update(measure_raw=MEASURE_RAW_VIEW, measure_clean=MEASURE_CLEAN_VIEW)
    return names
