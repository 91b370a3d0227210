"""Nested records -> flat rows.

One grant becomes one row per instrument. A grant without components, and a
component without instruments, still give one row, with '' for the missing
text and NULL for the missing amounts (``posexplode_outer``). Every step is
narrow: the plan from text scan to flat rows has no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidspark.functions.text import normalize_text, parse_amount, year_month
from aidspark.schemas import (AID_COLUMNS, COMPONENT_FIELDS, CORRUPT_COL, GRANT_FIELDS,
                              INSTRUMENT_AMOUNT_FIELDS, INSTRUMENT_TEXT_FIELDS, MEASURE_COLUMNS,
                              MEASURE_FIELDS)

ARRIVAL = "_arrival"


def _text(parent: str, tag: str) -> Column:
    # First occurrence of the tag, whitespace squeezed, missing -> ''.
    return normalize_text(F.get(F.col(f"{parent}.{tag}"), 0))


def _children(container: Column, child: str) -> Column:
    """All ``child`` elements under all (possibly repeated or empty) containers."""
    kept = F.filter(container, lambda x: x[child].isNotNull())
    return F.flatten(F.transform(kept, lambda x: x[child]))


STATUS = "_stato"
# --- fixed values: row status of an ingest ------------------------------------
OK, YEAR_ZERO, CORRUPT, EMPTY = "ok", "anno_zero", "corrotto", "vuoto"


def _status(present: Column, corrupt: Column, year: Column) -> Column:
    return (F.when(~present, F.lit(EMPTY)).when(corrupt.isNotNull(), F.lit(CORRUPT))
            .when(year == 0, F.lit(YEAR_ZERO)).otherwise(F.lit(OK)))


def flatten_aid(parsed: DataFrame) -> DataFrame:
    """Parsed ``<AIUTO>`` records -> 31-column rows plus ``_arrival``,
    ``_stato`` and the corrupt text.

    ``_arrival`` = (file, split offset, record order, component position,
    instrument position): the row's position in the source, used for keep-last
    dedup. ``_stato`` is ok / anno_zero / corrotto / vuoto; nothing is
    filtered, so a writer can split the statuses in the same pass. Grant
    fields are projected before exploding, so each output row copies flat
    columns, not the nested record."""
    grant = parsed.select(
        "_file", "_block", "_seq", F.col("r").isNotNull().alias("_present"),
        F.col(f"r.{CORRUPT_COL}").alias(CORRUPT_COL),
        *[_text("r", tag).alias(col) for tag, col in GRANT_FIELDS],
        F.posexplode_outer(_children(F.col("r.COMPONENTI_AIUTO"), "COMPONENTE_AIUTO")).alias("_ci", "c"))
    comp = grant.select(
        *[c for c in grant.columns if c != "c"],
        *[_text("c", tag).alias(col) for tag, col in COMPONENT_FIELDS],
        F.posexplode_outer(_children(F.col("c.STRUMENTI_AIUTO"), "STRUMENTO_AIUTO")).alias("_ii", "s"))
    y, m = year_month(F.col("data_concessione"))
    inst = comp.select(
        *[c for c in comp.columns if c != "s"],
        *[_text("s", tag).alias(col) for tag, col in INSTRUMENT_TEXT_FIELDS],
        *[parse_amount(F.get(F.col(f"s.{tag}"), 0)).alias(col) for tag, col in INSTRUMENT_AMOUNT_FIELDS],
        y.alias("anno"), m.alias("mese"))
    return inst.select(*AID_COLUMNS,
                       F.struct("_file", "_block", "_seq", "_ci", "_ii").alias(ARRIVAL),
                       _status(F.col("_present"), F.col(CORRUPT_COL), F.col("anno")).alias(STATUS),
                       CORRUPT_COL, "_file")


def flatten_measure(parsed: DataFrame) -> DataFrame:
    """Parsed ``<MISURA>`` records -> 20-column rows (one per measure) plus
    ``_arrival`` and ``_stato``. Year and month come from the first 10
    characters of the start date."""
    cols = {}
    for tag, col, kind in MEASURE_FIELDS:
        first = F.get(F.col(f"r.{tag}"), 0)
        cols[col] = parse_amount(first) if kind == "amount" else normalize_text(first)
    start = cols["data_inizio_misura"]
    y, m = year_month(F.substring(start, 1, 10))
    cols["anno"], cols["mese"] = y, m
    flat = parsed.select(*[cols[c].alias(c) for c in MEASURE_COLUMNS],
                         F.struct("_file", "_block", "_seq").alias(ARRIVAL),
                         F.col("r").isNotNull().alias("_present"), F.col(f"r.{CORRUPT_COL}").alias(CORRUPT_COL))
    return flat.select(*MEASURE_COLUMNS, ARRIVAL,
                       _status(F.col("_present"), F.col(CORRUPT_COL), F.col("anno")).alias(STATUS))


def reject_invalid_year(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a year, rows with year 0), as lazy filters."""
    ok = F.col("anno") != 0
    return rows.where(ok), rows.where(~ok)
