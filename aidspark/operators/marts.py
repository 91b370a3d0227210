"""Aggregate marts over the clean layer.

Plan shape, for every aid mart: filter -> partial aggregate (map-side) ->
shuffle on the group key -> final aggregate -> windows on the aggregated rows
(years x groups: thousands, not millions) -> sort of the small result. At most
one exact COUNT(DISTINCT) per aggregate, so no Expand. Shares are
``SUM(x) / SUM(SUM(x)) OVER (PARTITION BY ...)`` computed on aggregated rows.

Ties in ROW_NUMBER and top-k get the group keys as tie-breakers so results are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aidspark.functions.money import mean, money, pct, round_double, rounded, share_of, total
from aidspark.functions.nace import section_label, section_letter
from aidspark.operators.clean import MISSING_REGION

AMOUNT = "elemento_aiuto"
FIRM = "codice_fiscale_beneficiario"
REGION = "regione_beneficiario"
SECTION = "sezione"

# --- fixed values: pivoted beneficiary types of the territory mart -------------
TYPE_SHARES = [("PMI", "quota_pmi_pct"),
               ("Grande Impresa", "quota_grande_pct"),
               ("Microimpresa", "quota_micro_pct")]
UNKNOWN_TYPE = "-"
ACTIVE_CUTOFF = "2026-01-01"
OPEN_END_PREFIX = "9999"


def _nonblank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


# Columns of rows that were counted before (``lattice.base``): rows, exact total
# and number of amounts. The marts take such rows as they take clean ones.
ROWS, TOTAL, AMOUNTS = "_righe", "_totale", "_importi"


def _counted(df: DataFrame) -> bool:
    return ROWS in df.columns


def _n(df: DataFrame) -> Column:
    return F.sum(ROWS).cast("bigint") if _counted(df) else F.count(F.lit(1))


def _total(df: DataFrame) -> Column:
    return F.try_sum(TOTAL) if _counted(df) else total(AMOUNT)


def _mean(df: DataFrame) -> Column:
    return _total(df).cast("double") / F.nullif(F.sum(AMOUNTS), F.lit(0)) if _counted(df) else mean(AMOUNT)


def _measured(df: DataFrame) -> list[str]:
    """The columns that ``_n``, ``_total`` and ``_mean`` read."""
    return [ROWS, TOTAL, AMOUNTS] if _counted(df) else [AMOUNT]


def _firms(alias: str = "imprese") -> Column:
    return F.countDistinct(FIRM).alias(alias)


def _amounts(df: DataFrame, with_mean: bool = True) -> list[Column]:
    out = [_total(df).alias("_tot")]
    if with_mean:
        out.append(round_double(_mean(df), 0).alias("media_esl"))
    return out


def _finish_total(df: DataFrame, raw: str = "_tot", name: str = "totale_esl") -> DataFrame:
    return df.withColumn(name, rounded(F.col(raw)))


def _rank(partition: list[str], raw: str, tiebreak: list[str]) -> Column:
    w = Window.partitionBy(*partition).orderBy(F.col(raw).desc(), *[F.col(t).asc() for t in tiebreak])
    return F.row_number().over(w).cast("bigint")


def _year(df: DataFrame, year: int | None) -> DataFrame:
    return df if year is None else df.where(F.col("anno") == year)


# ---------------------------------------------------------------- M1
def mart_per_regione(clean: DataFrame) -> DataFrame:
    g = (clean.where(F.col(REGION) != MISSING_REGION)
         .groupBy("anno", REGION)
         .agg(_firms(), _n(clean).alias("aiuti"), *_amounts(clean)))
    return (_finish_total(g).select("anno", REGION, "imprese", "aiuti", "totale_esl", "media_esl")
            .orderBy(F.desc("anno"), F.desc("totale_esl")))


# ---------------------------------------------------------------- M2
def mart_per_procedimento(clean: DataFrame) -> DataFrame:
    g = (clean.where(F.col("procedimento") != "")
         .groupBy("anno", "procedimento")
         .agg(_n(clean).alias("aiuti"), *_amounts(clean, with_mean=False)))
    return (_finish_total(g).select("anno", "procedimento", "aiuti", "totale_esl")
            .orderBy(F.desc("anno"), F.desc("totale_esl")))


# ---------------------------------------------------------------- M3
def mart_top_beneficiari(clean: DataFrame, n: int = 1000, year: int | None = None) -> DataFrame:
    """Top-n (fiscal code, name, region) by total. ``orderBy().limit()`` becomes
    TakeOrderedAndProject: each task keeps n rows, one merge of n x tasks."""
    keys = [FIRM, "denominazione_beneficiario", REGION]
    g = (_year(clean, year).where(F.col(FIRM) != "")
         .groupBy(*keys).agg(_n(clean).alias("aiuti"), *_amounts(clean)))
    return (_finish_total(g).select(*keys, "aiuti", "totale_esl", "media_esl")
            .orderBy(F.desc("totale_esl"), *[F.asc(k) for k in keys]).limit(n))


# ---------------------------------------------------------------- M4
def mart_per_obiettivo(clean: DataFrame) -> DataFrame:
    g = (clean.where(_nonblank("cod_obiettivo"))
         .groupBy("anno", "cod_obiettivo", "obiettivo")
         .agg(_n(clean).alias("aiuti"), _firms(), *_amounts(clean)))
    g = _finish_total(g).withColumn("quota_pct_su_anno", share_of("_tot", "anno"))
    return (g.select("anno", "cod_obiettivo", "obiettivo", "aiuti", "imprese", "totale_esl",
                     "media_esl", "quota_pct_su_anno")
            .orderBy(F.desc("anno"), F.desc("totale_esl")))


# ---------------------------------------------------------------- M5
def mart_per_strumento(clean: DataFrame) -> DataFrame:
    """Instrument (by text) per year: total, share of the year, rank in the year
    (rank on the exact sum, not the rounded one)."""
    g = (clean.where(_nonblank("strumento"))
         .groupBy("anno", "strumento")
         .agg(_n(clean).alias("aiuti"), *_amounts(clean)))
    g = (_finish_total(g)
         .withColumn("quota_pct_su_anno", share_of("_tot", "anno"))
         .withColumn("rank_per_anno", _rank(["anno"], "_tot", ["strumento"])))
    return (g.select("anno", "strumento", "aiuti", "totale_esl", "media_esl",
                     "quota_pct_su_anno", "rank_per_anno")
            .orderBy(F.desc("anno"), F.asc("rank_per_anno")))


# ---------------------------------------------------------------- M6
def mart_tipo_beneficiario(clean: DataFrame) -> DataFrame:
    g = (clean.where(F.col("tipo_beneficiario").isNotNull()
                     & (F.col("tipo_beneficiario") != UNKNOWN_TYPE)
                     & (F.col(REGION) != MISSING_REGION))
         .groupBy("anno", "tipo_beneficiario", REGION)
         .agg(_firms(), _n(clean).alias("aiuti"), *_amounts(clean)))
    g = _finish_total(g).withColumn("quota_pct_su_regione", share_of("_tot", "anno", REGION))
    return (g.select("anno", "tipo_beneficiario", REGION, "imprese", "aiuti", "totale_esl",
                     "media_esl", "quota_pct_su_regione")
            .orderBy(F.desc("anno"), F.asc(REGION), F.desc("totale_esl")))


# ---------------------------------------------------------------- M7 / M10
def mart_settore_regione(clean: DataFrame) -> DataFrame:
    """NACE macro-sector x region x year. Unclassified codes are dropped before
    aggregating, so shares are of classified aid only.

    Grouped by the one-letter section; the label is attached after the
    aggregate (labels start with their letter, so ordering is the same)."""
    sez = F.col(SECTION) if SECTION in clean.columns else section_letter("settore_attivita")
    s = (clean.where(F.col(REGION) != MISSING_REGION)
         .select("anno", F.col(REGION).alias("regione"), sez.alias("_sez"), *_measured(clean), FIRM)
         .where(F.col("_sez").isNotNull()))
    g = (s.groupBy("anno", "regione", "_sez")
         .agg(_n(clean).alias("aiuti"), _firms(), *_amounts(clean)))
    g = (_finish_total(g)
         .withColumn("macro_settore", section_label("_sez"))
         .withColumn("quota_pct_su_regione", share_of("_tot", "anno", "regione"))
         .withColumn("rank_in_regione", _rank(["anno", "regione"], "_tot", ["_sez"])))
    return (g.select("anno", "regione", "macro_settore", "aiuti", "imprese", "totale_esl",
                     "media_esl", "quota_pct_su_regione", "rank_in_regione")
            .orderBy(F.desc("anno"), F.asc("regione"), F.asc("rank_in_regione")))


mart_settori = mart_settore_regione


# ---------------------------------------------------------------- M8
def mart_territorio(clean: DataFrame, type_shares=TYPE_SHARES) -> DataFrame:
    """Region x year with national benchmarks and pivoted beneficiary-type shares.

    The type shares are aggregated and pivoted to one row per (year, region)
    before the left join, so the join is 1:1 on two small aggregates."""
    base = clean.where(F.col(REGION) != MISSING_REGION)
    regioni = _finish_total(
        base.groupBy("anno", F.col(REGION).alias("regione"))
        .agg(_firms(), _n(clean).alias("aiuti"), *_amounts(clean)))
    tipi = (base.where(F.col("tipo_beneficiario").isNotNull() & (F.col("tipo_beneficiario") != UNKNOWN_TYPE))
            .groupBy("anno", F.col(REGION).alias("regione"), "tipo_beneficiario")
            .agg(_total(clean).alias("_tot_tipo"))
            .withColumn("_quota", share_of("_tot_tipo", "anno", "regione")))
    pivot = tipi.groupBy("anno", "regione").agg(*[
        F.max(F.when(F.col("tipo_beneficiario") == label, F.col("_quota"))).alias(name)
        for label, name in type_shares])
    j = regioni.join(pivot, ["anno", "regione"], "left")
    w = Window.partitionBy("anno")
    wr = Window.partitionBy("anno").orderBy(F.asc_nulls_last("totale_esl"))
    out = (j.withColumn("media_nazionale_esl", F.round(F.avg("totale_esl").over(w), 0))
           .withColumn("std_nazionale_esl", F.round(F.stddev_samp("totale_esl").over(w), 0))
           .withColumn("percentile_esl", F.when(F.col("totale_esl").isNotNull(),
                                                round_double(F.percent_rank().over(wr), 4))))
    return (out.select("anno", "regione", "imprese", "aiuti", "totale_esl", "media_esl",
                       "media_nazionale_esl", "std_nazionale_esl", "percentile_esl",
                       *[name for _l, name in type_shares])
            .orderBy(F.desc("anno"), F.desc("totale_esl")))


# ---------------------------------------------------------------- M9
def mart_policy(clean: DataFrame) -> DataFrame:
    """Objective part UNION ALL instrument part (grouped by code and text)."""
    def part(dim, code, text):
        g = (clean.where(_nonblank(code if dim == "obiettivo" else text))
             .groupBy("anno", F.col(code).alias("codice"), F.col(text).alias("descrizione"))
             .agg(_n(clean).alias("aiuti"), _firms(), *_amounts(clean)))
        g = _finish_total(g).withColumn("quota_pct_su_anno", share_of("_tot", "anno"))
        return g.select("anno", F.lit(dim).alias("dimensione"), "codice", "descrizione", "aiuti",
                        "imprese", "totale_esl", "media_esl", "quota_pct_su_anno")
    u = part("obiettivo", "cod_obiettivo", "obiettivo").unionByName(
        part("strumento", "cod_strumento", "strumento"))
    return u.orderBy(F.desc("anno"), F.asc("dimensione"), F.desc("totale_esl"))


# ---------------------------------------------------------------- M11
def mart_top(clean: DataFrame, n: int = 1000) -> DataFrame:
    """Top-n beneficiaries UNION ALL per-procedure totals (NULL region and mean)."""
    keys = [FIRM, "denominazione_beneficiario", REGION]
    top = _finish_total(
        clean.where((F.col(FIRM) != "") & (F.col("denominazione_beneficiario") != ""))
        .groupBy(*keys).agg(_n(clean).alias("aiuti"), *_amounts(clean)))
    top = (top.orderBy(F.desc("totale_esl"), *[F.asc(k) for k in keys]).limit(n)
           .select(F.lit("beneficiario").alias("dimensione"), F.col(FIRM).alias("codice"),
                   F.col("denominazione_beneficiario").alias("descrizione"),
                   F.col(REGION).alias("regione"), "aiuti", "totale_esl", "media_esl"))
    proc = _finish_total(
        clean.where(_nonblank("cod_procedimento"))
        .groupBy(F.col("cod_procedimento").alias("codice"), F.col("procedimento").alias("descrizione"))
        .agg(_n(clean).alias("aiuti"), *_amounts(clean, with_mean=False)))
    proc = proc.select(F.lit("procedimento").alias("dimensione"), "codice", "descrizione",
                       F.lit(None).cast("string").alias("regione"), "aiuti", "totale_esl",
                       F.lit(None).cast("double").alias("media_esl"))
    return top.unionByName(proc).orderBy(F.asc("dimensione"), F.desc("totale_esl"))


# ---------------------------------------------------------------- M12-M14 (measures)
def is_active(end: Column, cutoff: str = ACTIVE_CUTOFF) -> Column:
    """Open or future end date. Dates are compared as text, on purpose."""
    return (end.isNull() | (end == "") | end.startswith(OPEN_END_PREFIX) | (end > F.lit(cutoff)))


def mart_misure_per_tipo(measures: DataFrame) -> DataFrame:
    g = (measures.where(F.col("des_tipo_misura").isNotNull())
         .groupBy("des_tipo_misura")
         .agg(F.count(F.lit(1)).alias("n_misure"),
              total("importo_prestiti_garantiti").alias("_p"),
              total("importo_aiuto_ad_hoc").alias("_a")))
    return (g.select("des_tipo_misura", "n_misure",
                     rounded(F.col("_p")).alias("prestiti_garantiti_eur"),
                     rounded(F.col("_a")).alias("aiuto_ad_hoc_eur"),
                     rounded(F.col("_p") + F.col("_a")).alias("totale_eur"))
            .orderBy(F.desc("totale_eur")))


def mart_misure_attive(measures: DataFrame, cutoff: str = ACTIVE_CUTOFF) -> DataFrame:
    act = F.when(is_active(F.col("data_fine_misura"), cutoff), 1).otherwise(0)
    g = (measures.where(F.col("anno").isNotNull())
         .groupBy("anno")
         .agg(F.count(F.lit(1)).alias("n_misure_istituite"), F.sum(act).cast("bigint").alias("ancora_attive")))
    return (g.withColumn("quota_attive_pct", pct(F.col("ancora_attive"), F.col("n_misure_istituite"), 1))
            .orderBy(F.desc("anno")))


def mart_top_misure(measures: DataFrame, cutoff: str = ACTIVE_CUTOFF) -> DataFrame:
    """One row per measure window with amounts and status. No limit: the
    result is the whole measure table ordered by total."""
    p, a = money("importo_prestiti_garantiti"), money("importo_aiuto_ad_hoc")
    return (measures.where(F.col("car").isNotNull())
            .select("car", "titolo_misura", "des_tipo_misura", "des_autorita", "autorita_concedente",
                    "data_inizio_misura",
                    rounded(p).alias("prestiti_garantiti_eur"),
                    rounded(a).alias("aiuto_ad_hoc_eur"),
                    rounded(p + a).alias("totale_eur"),
                    F.when(is_active(F.col("data_fine_misura"), cutoff), F.lit("attiva"))
                    .otherwise(F.lit("scaduta")).alias("stato"))
            .orderBy(F.desc("totale_eur")))


AID_MARTS = {
    "mart_per_regione": mart_per_regione,
    "mart_per_procedimento": mart_per_procedimento,
    "mart_top_beneficiari": mart_top_beneficiari,
    "mart_per_obiettivo": mart_per_obiettivo,
    "mart_per_strumento": mart_per_strumento,
    "mart_tipo_beneficiario": mart_tipo_beneficiario,
    "mart_settore_regione": mart_settore_regione,
    "mart_territorio": mart_territorio,
    "mart_policy": mart_policy,
    "mart_settori": mart_settori,
    "mart_top": mart_top,
}
MEASURE_MARTS = {
    "mart_misure_per_tipo": mart_misure_per_tipo,
    "mart_misure_attive": mart_misure_attive,
    "mart_top_misure": mart_top_misure,
}
