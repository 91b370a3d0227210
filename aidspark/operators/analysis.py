"""Documented analyst queries (Q0-Q10).

Q1-Q10 run over the raw layer (all years): NULL amounts and '' regions stay
in. Q0 runs over the published clean layer. Year and search term are
parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidspark.functions.money import MONEY, mean, money, round_double, rounded, share_of, total

AMOUNT = "elemento_aiuto"
FIRM = "codice_fiscale_beneficiario"
REGION = "regione_beneficiario"
NO_CUP = ("", "n.d.")


def _n():
    return F.count(F.lit(1))


def _year(df: DataFrame, year: int | None) -> DataFrame:
    return df if year is None else df.where(F.col("anno") == year)


def q_total_by_region(clean: DataFrame, year: int | None = None) -> DataFrame:
    """Q0: total by region of one published clean year (all years if None)."""
    g = _year(clean, year).groupBy(REGION).agg(rounded(total(AMOUNT)).alias("totale"))
    return g.orderBy(F.desc("totale"))


def q_region_year(raw: DataFrame) -> DataFrame:
    """Q1: total and distinct firms by year and region."""
    g = raw.groupBy("anno", REGION).agg(rounded(total(AMOUNT)).alias("totale_erogato"),
                                        F.countDistinct(FIRM).alias("n_imprese"))
    return g.orderBy(F.asc("anno"), F.desc("totale_erogato"))


def q_procedure_trend(raw: DataFrame) -> DataFrame:
    """Q2: total and distinct beneficiaries by year and procedure."""
    g = raw.groupBy("anno", "procedimento").agg(rounded(total(AMOUNT)).alias("totale"),
                                               F.countDistinct(FIRM).alias("n_beneficiari"))
    return g.orderBy(F.asc("anno"), F.desc("totale"))


def q_find_company(raw: DataFrame, term: str) -> DataFrame:
    """Q3: grants whose beneficiary name contains ``term`` (literal substring),
    newest first. A pure scan + filter; the sort is on the filtered rows."""
    return (raw.where(F.col("denominazione_beneficiario").contains(term))
            .select("denominazione_beneficiario", FIRM, "data_concessione", "soggetto_concedente",
                    "titolo_misura", round_double(F.col(AMOUNT), 2).alias("importo"),
                    "procedimento", REGION)
            .orderBy(F.desc("data_concessione")))


def q_top_grantors(raw: DataFrame, year: int, n: int = 10) -> DataFrame:
    """Q4: top-n granting bodies of one year (partition-pruned on ``anno``)."""
    g = (raw.where(F.col("anno") == year).groupBy("soggetto_concedente")
         .agg(rounded(total(AMOUNT)).alias("totale_erogato"), _n().alias("n_aiuti"),
              F.countDistinct(FIRM).alias("n_imprese")))
    return g.orderBy(F.desc("totale_erogato"), F.asc("soggetto_concedente")).limit(n)


def q_top_sectors(raw: DataFrame, n: int = 20) -> DataFrame:
    """Q5: top-n activity codes: firms, total, mean."""
    g = (raw.where((F.col("settore_attivita") != "") & F.col(AMOUNT).isNotNull())
         .groupBy("settore_attivita")
         .agg(F.countDistinct(FIRM).alias("n_imprese"), rounded(total(AMOUNT)).alias("totale"),
              round_double(mean(AMOUNT), 2).alias("importo_medio")))
    return g.orderBy(F.desc("totale"), F.asc("settore_attivita")).limit(n)


def q_per_capita(raw: DataFrame, population: DataFrame, year: int) -> DataFrame:
    """Q6: aid per head, of the residents of the same year. Both sides are aggregated per region before the inner
    join, so the join is between two region-sized tables."""
    aid = (raw.where(F.col("anno") == year).groupBy(REGION)
           .agg(rounded(total(AMOUNT)).alias("totale_aiuti")))
    pop = population.where(F.col("anno") == year).groupBy("regione").agg(F.sum("popolazione").cast("bigint").alias("residenti"))
    j = aid.join(pop, aid[REGION] == pop["regione"])
    return (j.select(REGION, "totale_aiuti", "residenti",
                     round_double(F.col("totale_aiuti") / F.col("residenti"), 2).alias("aiuto_procapite"))
            .orderBy(F.desc("aiuto_procapite")))


def q_cumulation(raw: DataFrame, year: int, min_measures: int = 5) -> DataFrame:
    """Q7: firms with more than ``min_measures`` distinct measures in a year."""
    g = (raw.where(F.col("anno") == year)
         .groupBy(FIRM, "denominazione_beneficiario")
         .agg(F.countDistinct("titolo_misura").alias("n_misure_distinte"),
              rounded(total(AMOUNT)).alias("totale_complessivo")))
    return g.where(F.col("n_misure_distinte") > min_measures).orderBy(F.desc("totale_complessivo"))


def q_monthly_trend(raw: DataFrame) -> DataFrame:
    """Q8: rows and total per (year, month)."""
    g = raw.groupBy("anno", "mese").agg(_n().alias("n_aiuti"),
                                        rounded(total(AMOUNT)).alias("totale_mensile"))
    return g.orderBy("anno", "mese")


def q_instrument_share(raw: DataFrame) -> DataFrame:
    """Q9: each instrument's share of the grand total, one decimal.

    The grand total is a window over the aggregated rows, one row per
    instrument type (the register's instrument code list: dozens of rows), so
    the un-partitioned window moves only those rows to one task. A scalar
    subquery would instead scan the input a second time."""
    g = (raw.where(F.col("strumento") != "").groupBy("strumento")
         .agg(_n().alias("n"), total(AMOUNT).alias("_tot"),
              round_double(mean(AMOUNT), 2).alias("importo_medio")))
    return (g.select("strumento", "n", rounded(F.col("_tot")).alias("totale"), "importo_medio",
                     share_of("_tot", digits=1).alias("percentuale"))
            .orderBy(F.desc("totale")))


def q_cup_traceability(raw: DataFrame) -> DataFrame:
    """Q10: rows and amounts with and without a project code, per year."""
    cup = F.col("cup")
    has = (cup != NO_CUP[0]) & (cup != NO_CUP[1])
    missing = (cup == NO_CUP[0]) | (cup == NO_CUP[1])
    zero = F.lit(0).cast(MONEY)
    g = raw.groupBy("anno").agg(
        F.sum(F.when(has, 1).otherwise(0)).cast("bigint").alias("con_cup"),
        F.sum(F.when(missing, 1).otherwise(0)).cast("bigint").alias("senza_cup"),
        rounded(F.sum(F.when(has, money(AMOUNT)).otherwise(zero))).alias("importo_con_cup"),
        rounded(F.sum(F.when(missing, money(AMOUNT)).otherwise(zero))).alias("importo_senza_cup"))
    return g.orderBy("anno")
