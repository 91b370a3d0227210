"""Keyed joins to other datasets.

Every join pre-aggregates the aid side to the join key first, so the shuffle
carries one row per key instead of every grant row, and a hot key (one firm
with a third of all rows) is collapsed by the map-side partial aggregate
before it reaches a reducer. Join strategy is left to the optimizer: AQE
broadcasts a side only when its measured runtime size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidspark.functions.money import money, pct, rounded, total

AMOUNT = "elemento_aiuto"


def normalize_key(c) -> Column:
    """Join-key normalisation: trim, upper case; '' stays '' (excluded by callers)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.upper(F.trim(col))


def measure_per_car(measures: DataFrame) -> DataFrame:
    """One row per ``car``: the latest validity window (max start date).

    ``car`` repeats over windows, so joining the raw measure table would fan
    out aid rows; ``max_by`` keeps one window per car in a single aggregate."""
    latest = F.max_by(F.struct("titolo_misura", "data_inizio_misura", "importo_prestiti_garantiti",
                               "importo_aiuto_ad_hoc"), F.col("data_inizio_misura"))
    return (measures.where(F.col("car").isNotNull() & (F.col("car") != ""))
            .groupBy("car").agg(latest.alias("m"), F.count(F.lit(1)).alias("n_finestre"))
            .select("car", "n_finestre", "m.titolo_misura", "m.data_inizio_misura",
                    (money("m.importo_prestiti_garantiti") + money("m.importo_aiuto_ad_hoc")).alias("_plafond")))


def join_aid_measure(clean: DataFrame, measures: DataFrame) -> DataFrame:
    """Aid paid out per measure against the measure's ceiling."""
    aid = (clean.where(F.col("car") != "").groupBy("car")
           .agg(F.count(F.lit(1)).alias("aiuti"), total(AMOUNT).alias("_erogato")))
    j = aid.join(measure_per_car(measures), "car", "left")
    return j.select("car", "aiuti", rounded(F.col("_erogato")).alias("erogato_esl"),
                    "titolo_misura", "data_inizio_misura", "n_finestre",
                    rounded(F.col("_plafond")).alias("plafond_eur"),
                    pct(F.col("_erogato"), F.col("_plafond"), 2).alias("quota_erogata_pct"))


def _present(aid: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``aid`` whose key the other side has. Spark broadcasts small sides;
    for larger ones it builds a Bloom filter of their keys, which drops rows at the
    scan (``might_contain``), from 10 GB of aid on by default."""
    return aid.join(keys.select(key), key, "left_semi")


def join_by_fiscal_code(aid: DataFrame, entities: DataFrame, entity_key: str = "codice_fiscale",
                        prefilter: bool = False) -> DataFrame:
    """Firms present in another dataset keyed by fiscal code. ``prefilter``: rows
    of absent firms are dropped before the aid side is grouped, which pays where
    most firms are absent; without it the aid side is grouped as a whole."""
    a = (aid.select(normalize_key("codice_fiscale_beneficiario").alias("codice_fiscale"), AMOUNT)
         .where(F.col("codice_fiscale") != ""))
    if prefilter:
        wanted = entities.select(normalize_key(entity_key).alias("codice_fiscale")).where(F.col("codice_fiscale") != "")
        a = _present(a, wanted, "codice_fiscale")
    a = (a.groupBy("codice_fiscale").agg(F.count(F.lit(1)).alias("aiuti"), total(AMOUNT).alias("_tot")))
    e = (entities.select(normalize_key(entity_key).alias("codice_fiscale"))
         .where(F.col("codice_fiscale") != "")
         .groupBy("codice_fiscale").agg(F.count(F.lit(1)).alias("n_record_entita")))
    return a.join(e, "codice_fiscale").select(
        "codice_fiscale", "aiuti", rounded(F.col("_tot")).alias("totale_esl"), "n_record_entita")


def join_by_cup_bridge(aid: DataFrame, bridge: DataFrame, no_cup=("", "n.d."), prefilter: bool = False) -> DataFrame:
    """Project code -> municipality through a bridge table (two hops:
    aid per CUP, CUP -> municipality, then totals per municipality).
    ``prefilter`` as in ``join_by_fiscal_code``."""
    coded = aid.where(~F.col("cup").isin(*no_cup) & F.col("cup").isNotNull()).select("cup", AMOUNT)
    if prefilter:
        coded = _present(coded, bridge.where(~F.col("cup").isin(*no_cup)), "cup")
    per_cup = (coded.groupBy("cup").agg(F.count(F.lit(1)).alias("_n"), total(AMOUNT).alias("_tot")))
    br = bridge.where(~F.col("cup").isin(*no_cup)).select("cup", "comune").distinct()
    j = per_cup.join(br, "cup")
    return (j.groupBy("comune")
            .agg(F.count(F.lit(1)).alias("n_progetti"), F.sum("_n").cast("bigint").alias("aiuti"),
                 rounded(F.sum("_tot")).alias("totale_esl")))


def join_by_region(clean: DataFrame, territory: DataFrame) -> DataFrame:
    """Aid per region joined to a territory table keyed by region name."""
    a = (clean.where(F.col("regione_beneficiario") != "ND")
         .groupBy(F.col("regione_beneficiario").alias("regione"))
         .agg(F.count(F.lit(1)).alias("aiuti"), total(AMOUNT).alias("_tot")))
    j = a.join(territory.select("regione", "macro_area").distinct(), "regione")
    return j.select("macro_area", "regione", "aiuti", rounded(F.col("_tot")).alias("totale_esl"))
