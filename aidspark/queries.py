"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one reads the driver tables through the stand-in builders and runs the
library operator on the whole input. Queries that write (ingest, storage,
streaming) use fresh folders under the shared scratch root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aidspark.functions import text as T
from aidspark.operators import analysis as A
from aidspark.operators import catalog as CT
from aidspark.operators import clean as C
from aidspark.operators import distinct as DI
from aidspark.operators import flatten as FL
from aidspark.operators import joinable as JO
from aidspark.operators import joins as J
from aidspark.operators import lattice as LT
from aidspark.operators import marts as M
from aidspark.operators import quality as Q
from aidspark.operators.dedup import dedup_keep_last
from aidspark.plans import bucketed as BK
from aidspark.plans import layers as L
from aidspark.plans import manifest as MF
from aidspark.plans import storage as ST
from aidspark.plans.yeartable import YearTable
from aidspark.schemas import AID_DEDUP_KEY, AID_SCHEMA, MEASURE_KEY, MEASURE_SCHEMA
from aidspark.session import prepare, scratch_dir
from aidspark.sources import standin as S
from aidspark.sources import text_standin as TS
from aidspark.sources import xml as X
from aidspark.sources import xml_standin as XS

# --- parameters of the registered queries (the oracle uses the same values) ---
Q_YEAR = 1998                      # analyst queries on one year (Q4, Q6, Q7)
Q_TERM = "#00000012"               # beneficiary-name search (Q3)
FILE_YEARS = (1996, 1997)          # file selection by year (S17)
OVERWRITE_YEARS = (1997, 1998)     # yearly overwrite (K2)
UPSERT_LAST_MONTH = 6              # last month of that year in the batch
UPSERT_FROM_YEAR = 1998            # first year of the upserted batch (K3)
REBUILD_YEARS = (1996, 1997)       # rebuilt range (K5)
READ_YEAR = 1997                   # single-year read (S19)
DROP_SPLIT_YEAR = 1998             # first year of the second streaming drop (K7)
INDEX_FROM_YEAR = 1998             # first year of the current manifest run (D2)
KEY_BUCKETS = 16                   # least buckets of a table by grant key (K1)
JOINABLE_LEAST = 0.5               # least containment of joinable columns (D5)
# Publication window of the stand-in register (first year, last year, months
# published in the last year), used by the manifests.
STANDIN_COVERAGE = (1995, 2001, 8)
Query = Callable[[SparkSession, str], DataFrame]


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_aid(S.aid_raw(prepare(spark), sf_dir))


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_measure(S.measure_raw(prepare(spark), sf_dir))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.aid_raw(prepare(spark), sf_dir)


def _aid_xml(spark: SparkSession, sf_dir: str) -> str:
    """Write the generated aid dump to a fresh shared scratch folder."""
    return XS.write_aid_xml(prepare(spark), sf_dir, scratch_dir(spark, "aid-xml"))


def _measure_xml(spark: SparkSession, sf_dir: str) -> str:
    return XS.write_measure_xml(prepare(spark), sf_dir, scratch_dir(spark, "measure-xml"))


def ingest_aid(spark: SparkSession, path: str, years=None, statuses=(FL.OK,)) -> DataFrame:
    """S1 end to end: scan, repair, parse, flatten, split by status, conform."""
    return C.conform_schema(ST.ingest_aid(spark, path, scratch_dir(spark, "aid-staging"), years=years,
                                          statuses=statuses), AID_SCHEMA)


def ingest_measures(spark: SparkSession, path: str, statuses=(FL.OK,)) -> DataFrame:
    """S2 end to end."""
    return ST.ingest_measures(spark, path, scratch_dir(spark, "measure-staging"), statuses=statuses)


def _source_month(path_col="_file"):
    return F.regexp_extract(F.col(path_col), r"OpenData_Aiuti_\d{4}_\d{2}", 0)


def _arrived(spark, sf_dir):
    return S.aid_raw(prepare(spark), sf_dir, with_arrival=True)


def q_dedup_keep_last(spark, sf_dir):
    return dedup_keep_last(_arrived(spark, sf_dir), AID_DEDUP_KEY, "_arrival")


def q_write_year_overwrite(spark, sf_dir):
    """Write all years without dedup, then replace two years with deduped
    rows from a batch that also carries other years (strays, not written)."""
    base = scratch_dir(spark, "layer-raw")
    raw = _arrived(spark, sf_dir)
    ST.write_year_overwrite(raw, base)
    ST.write_year_overwrite(raw, base, years=OVERWRITE_YEARS, dedup=True)
    return ST.read_all_years(spark, base)


def q_upsert_append(spark, sf_dir):
    """Load years up to 1998 without dedup, then upsert a changed batch of the
    first months of 1998 and all later years: new rows win over old ones of
    their key; of keys only in the old rows of 1998 the last to arrive stays."""
    base = scratch_dir(spark, "layer-upsert")
    raw = _arrived(spark, sf_dir)
    ST.write_year_overwrite(raw.where(F.col("anno") <= UPSERT_FROM_YEAR), base)
    new = (raw.where((F.col("anno") > UPSERT_FROM_YEAR)
                     | ((F.col("anno") == UPSERT_FROM_YEAR) & (F.col("mese") <= UPSERT_LAST_MONTH)))
           .withColumn("soggetto_concedente", F.concat("soggetto_concedente", F.lit(" (agg.)"))))
    ST.upsert_append(spark, new, base)
    return ST.read_all_years(spark, base)


def q_rebuild_years(spark, sf_dir):
    """Rebuild two years from the XML dump over an existing table."""
    base = scratch_dir(spark, "layer-rebuild")
    old = S.aid_raw(prepare(spark), sf_dir).withColumn(
        "soggetto_concedente", F.concat("soggetto_concedente", F.lit(" (vecchio)")))
    ST.write_year_overwrite(old, base)
    ST.rebuild_years(spark, _aid_xml(spark, sf_dir), base, *REBUILD_YEARS)
    return ST.read_all_years(spark, base)


def q_rebuild_measures(spark, sf_dir):
    path = scratch_dir(spark, "measures")
    ST.rebuild_measures(spark, _measure_xml(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_read_year(spark, sf_dir):
    base = scratch_dir(spark, "layer-read")
    ST.write_year_overwrite(S.aid_raw(prepare(spark), sf_dir), base)
    return ST.read_year(spark, base, READ_YEAR)


def q_read_all_years(spark, sf_dir):
    """Two loads with different columns, read back united by name."""
    base = scratch_dir(spark, "layer-merge")
    raw = S.aid_raw(prepare(spark), sf_dir)
    ST._write_years(raw.where(F.col("anno") < UPSERT_FROM_YEAR), base)
    ST._write_years(raw.where(F.col("anno") >= UPSERT_FROM_YEAR).withColumn("fonte", F.lit("lotto2")), base)
    return ST.read_all_years(spark, base)


def q_publish_layers(spark, sf_dir):
    """Clean is written once; the marts read the published files."""
    root = scratch_dir(spark, "publish")
    first = ST.publish_layers(spark, root, "aiuti_stato", "tutti", {"clean": {"aiuti_stato": _clean(spark, sf_dir)}})
    clean = spark.read.parquet(f"{root}/aiuti_stato/tutti/clean_aiuti_stato")
    return first.unionByName(ST.publish_layers(spark, root, "aiuti_stato", "tutti", {
        "mart": {name: fn(clean) for name, fn in M.AID_MARTS.items()}}))


def q_publish_years(spark, sf_dir):
    """The layers of every year of the raw table under ``{dataset}/{year}/``; rows
    as the runs counted them while writing."""
    spark = prepare(spark)
    root = scratch_dir(spark, "publish-years")
    raw, out = YearTable(spark, f"{root}/raw"), []
    for year in sorted(map(int, raw.overwrite(_raw(spark, sf_dir))["years"])):
        report = L.run_aid(spark, raw.read([year]), f"{root}/aiuti_stato", year=year)
        out.append((year, "clean", "clean", report["clean_rows"]))
        out += [(year, "mart", name, found["rows"]) for name, found in report["marts"].items()]
    return spark.createDataFrame(out, "anno int, layer string, tabella string, righe bigint")


def q_versioned_overwrite(spark, sf_dir):
    """``write_year_overwrite`` on a versioned year table."""
    table = YearTable(prepare(spark), scratch_dir(spark, "versioned-raw"))
    raw = _arrived(spark, sf_dir)
    table.overwrite(raw)
    table.overwrite(raw, years=OVERWRITE_YEARS, dedup=True)
    return table.read()


def q_versioned_upsert(spark, sf_dir):
    """``upsert_append`` on a versioned year table: the batch becomes a lot, the
    year that both share is compacted, the later years are merged on read."""
    table = YearTable(prepare(spark), scratch_dir(spark, "versioned-upsert"))
    raw = _arrived(spark, sf_dir)
    table.overwrite(raw.where(F.col("anno") <= UPSERT_FROM_YEAR))
    table.upsert(raw.where((F.col("anno") > UPSERT_FROM_YEAR)
                           | ((F.col("anno") == UPSERT_FROM_YEAR) & (F.col("mese") <= UPSERT_LAST_MONTH)))
                 .withColumn("soggetto_concedente", F.concat("soggetto_concedente", F.lit(" (agg.)"))))
    table.compact([UPSERT_FROM_YEAR])
    return table.read()


def q_versioned_rebuild(spark, sf_dir):
    """``rebuild_years`` on a versioned year table."""
    table = YearTable(prepare(spark), scratch_dir(spark, "versioned-rebuild"))
    table.overwrite(_raw(spark, sf_dir).withColumn("soggetto_concedente", F.concat("soggetto_concedente", F.lit(" (vecchio)"))))
    table.rebuild(_aid_xml(spark, sf_dir), *REBUILD_YEARS)
    return table.read()


def q_distinct_firms(spark, sf_dir):
    """Firms per year, region and procedure as bitmaps, written once; the counts
    of years, regions and of all years follow from them by OR."""
    spark, fine = prepare(spark), ["anno", "regione_beneficiario", "procedimento"]
    raw, root = _raw(spark, sf_dir), scratch_dir(spark, "firms")
    DI.firm_numbers(raw, M.FIRM).write.parquet(f"{root}/numbers")
    DI.firm_bitmaps(raw, spark.read.parquet(f"{root}/numbers"), M.FIRM, fine).write.parquet(f"{root}/bitmaps")
    bitmaps, out = spark.read.parquet(f"{root}/bitmaps"), None
    for dims in (fine, fine[:2], fine[:1], fine[1:2], []):
        level = DI.firm_counts(bitmaps, dims).select(
            *[F.col(c) if c in dims else F.lit(None).cast(bitmaps.schema[c].dataType).alias(c) for c in fine],
            F.lit(",".join(dims)).alias("livello"), "imprese")
        out = level if out is None else out.unionByName(level)
    return out


def q_joinable_pairs(spark, sf_dir):
    """Columns of the register, its measures and four other datasets that hold each
    other's values."""
    spark = prepare(spark)
    return JO.joinable_pairs({"aiuti": _raw(spark, sf_dir), "misure": _measures(spark, sf_dir),
                              "enti": S.entities(spark, sf_dir).select("codice_fiscale", "event_type"),
                              "ponte_cup": S.cup_bridge(spark, sf_dir), "territorio": S.territory(spark, sf_dir)}, JOINABLE_LEAST)


def q_footer_counts(spark, sf_dir):
    """Rows per year of a written raw layer, from its files' footers."""
    base = scratch_dir(prepare(spark), "layer-footers")
    ST.write_year_overwrite(_raw(spark, sf_dir), base)
    return CT.footer_counts(spark, base).select("anno", "righe")


def q_mart_base(spark, sf_dir):
    """The counted rows that all marts are groupings of, summed per set."""
    found = LT.base(_clean(spark, sf_dir)).groupBy(LT.SET).agg(
        F.count("*").alias("gruppi"), F.sum(M.ROWS).cast("bigint").alias("aiuti"), F.sum(M.AMOUNTS).cast("bigint").alias("importi"),
        F.round(F.try_sum(M.TOTAL), 0).cast("double").alias("totale_esl"))
    return found


def q_manifest_refresh(spark, sf_dir):
    """A manifest kept up by file: counted once, then only for the files of the
    years that were overwritten."""
    base, root = scratch_dir(prepare(spark), "layer-manifest"), scratch_dir(spark, "manifest-state")
    raw = _arrived(spark, sf_dir)
    ST.write_year_overwrite(raw, base)
    MF.refresh(spark, base, root)
    ST.write_year_overwrite(raw, base, years=OVERWRITE_YEARS, dedup=True)
    MF.refresh(spark, base, root)
    return MF.manifest(spark, root, STANDIN_COVERAGE)


def q_bucketed_dedup(spark, sf_dir):
    """``dedup_keep_last`` on a table bucketed by the grant key."""
    path = scratch_dir(prepare(spark), "bucketed")
    raw = _arrived(spark, sf_dir)
    table = BK.write_bucketed(raw, "aiuti_" + path.rsplit("-", 1)[1], path, AID_DEDUP_KEY, BK.buckets_for(raw, KEY_BUCKETS))
    return BK.keep_last(table, AID_DEDUP_KEY, "_arrival")


def q_salvage_malformed(spark, sf_dir):
    """Ingest of a dump in which seven of eight records have broken markup: every
    record is read with all its fields."""
    path = XS.write_damaged_aid_xml(prepare(spark), sf_dir, scratch_dir(spark, "aid-xml-damaged"))
    return C.conform_schema(ST.ingest_aid(spark, path, scratch_dir(spark, "salvage-staging"), salvage=True), AID_SCHEMA)


def q_ingest_prefixed(spark, sf_dir):
    """Ingest of a dump whose tags all carry a namespace prefix."""
    return ingest_aid(spark, XS.write_prefixed_aid_xml(prepare(spark), sf_dir, scratch_dir(spark, "aid-xml-prefixed")))


def q_dq_min_rows(spark, sf_dir):
    clean, meas = _clean(spark, sf_dir), _measures(spark, sf_dir)
    checks = [Q.dq_min_rows(clean, Q.AID_CLEAN_RULES["min_rows"], "aiuti_stato.clean"),
              Q.dq_min_rows(meas, Q.MEASURE_CLEAN_RULES["min_rows"], "misure.clean"),
              Q.dq_min_rows(M.mart_per_obiettivo(clean),
                            Q.AID_MART_RULES["mart_aiuti_per_obiettivo"]["min_rows"], "mart_aiuti_per_obiettivo")]
    for name, fn in M.MEASURE_MARTS.items():
        checks.append(Q.dq_min_rows(fn(meas), Q.MEASURE_MART_RULES[name]["min_rows"], name))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def q_dq_not_null(spark, sf_dir):
    return Q.dq_not_null(_clean(spark, sf_dir), Q.AID_CLEAN_RULES["not_null"], "aiuti_stato.clean") \
        .unionByName(Q.dq_not_null(_measures(spark, sf_dir), Q.MEASURE_CLEAN_RULES["not_null"], "misure.clean"))


def q_dq_primary_key(spark, sf_dir):
    """Repeated values of the aid key (raw layer) and of the measure key that
    the measure configuration gates."""
    def found(df, key, table):
        return Q.dq_primary_key(df, key).select(F.lit(table).alias("tabella"), F.concat_ws("|", *key).alias("chiave"),
                                                "occorrenze")
    twice = _measures(spark, sf_dir).select("car", "data_inizio_misura")
    return found(_raw(spark, sf_dir), AID_DEDUP_KEY, "aiuti.raw").unionByName(
        found(twice, MEASURE_KEY, "misure.clean"))


def q_run_signal(spark, sf_dir):
    """The signal of a whole layer run (clean and the registered marts)."""
    spark = prepare(spark)
    report = L.run_aid(spark, _raw(spark, sf_dir), scratch_dir(spark, "signal-run"))
    return L.signal(spark, report, "aiuti_stato").select("layer", "righe", "controlli", "superati",
                                                         "punteggio_qualita", "stato")


def q_manifest_by_year(spark, sf_dir):
    return CT.manifest_by_year(_raw(spark, sf_dir), STANDIN_COVERAGE)


def q_manifest_index(spark, sf_dir):
    """Previous index from the raw layer; the current run re-loads the years
    from INDEX_FROM_YEAR deduplicated; earlier years are carried over."""
    previous = CT.manifest_by_year(_raw(spark, sf_dir), STANDIN_COVERAGE)
    # a struct of an aggregate keeps all its columns: only those that the manifest
    # counts go through the sort and the shuffle of the deduplication
    counted = _arrived(spark, sf_dir).select("anno", "mese", *AID_DEDUP_KEY, "_arrival")
    current_rows = dedup_keep_last(counted.where(F.col("anno") >= INDEX_FROM_YEAR), AID_DEDUP_KEY, "_arrival")
    return CT.manifest_index(CT.manifest_by_year(current_rows, STANDIN_COVERAGE), previous)


def q_manifest_totals(spark, sf_dir):
    """Totals of the index that ``manifest_index`` gives."""
    return CT.index_totals(q_manifest_index(spark, sf_dir))


def q_file_summary(spark, sf_dir):
    base = scratch_dir(spark, "layer-files")
    ST.write_year_overwrite(_raw(spark, sf_dir), base)
    return CT.file_summary(spark, base).select("anno", "righe")


def q_incremental_load(spark, sf_dir, versioned=False):
    """Two monthly drops land in the inbox; each availableNow run merges only
    the files it has not seen (keep-last by key within and across drops)."""
    from aidspark.streaming.incremental import incremental_load
    spark = prepare(spark)
    inbox, ckpt = scratch_dir(spark, "inbox"), scratch_dir(spark, "stream-ckpt")
    table = scratch_dir(spark, "layer-stream")
    year = F.substring(F.col("f"), 16, 4).cast("int")
    XS.write_aid_drop(spark, sf_dir, f"{inbox}/drop1", year < DROP_SPLIT_YEAR)
    incremental_load(spark, inbox, table, ckpt, versioned=versioned)
    XS.write_aid_drop(spark, sf_dir, f"{inbox}/drop2", year >= DROP_SPLIT_YEAR)
    incremental_load(spark, inbox, table, ckpt, versioned=versioned)
    return YearTable(spark, table).read() if versioned else ST.read_all_years(spark, table)


def _aid_mart(fn) -> Query:
    return lambda spark, sf_dir: fn(_clean(spark, sf_dir))


def _measure_mart(fn) -> Query:
    return lambda spark, sf_dir: fn(_measures(spark, sf_dir))


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "clean_aid": _clean,
        "clean_measure": _measures,
    }
    for name, fn in M.AID_MARTS.items():
        q[name] = _aid_mart(fn)
    for name, fn in M.MEASURE_MARTS.items():
        q[name] = _measure_mart(fn)
    q.update({
        "q_total_by_region": lambda sp, d: A.q_total_by_region(_clean(sp, d)),
        "q_region_year": lambda sp, d: A.q_region_year(_raw(sp, d)),
        "q_procedure_trend": lambda sp, d: A.q_procedure_trend(_raw(sp, d)),
        "q_find_company": lambda sp, d: A.q_find_company(_raw(sp, d), Q_TERM),
        "q_top_grantors": lambda sp, d: A.q_top_grantors(_raw(sp, d), Q_YEAR),
        "q_top_sectors": lambda sp, d: A.q_top_sectors(_raw(sp, d)),
        "q_per_capita": lambda sp, d: A.q_per_capita(_raw(sp, d), S.population(sp, d), Q_YEAR),
        "q_cumulation": lambda sp, d: A.q_cumulation(_raw(sp, d), Q_YEAR),
        "q_monthly_trend": lambda sp, d: A.q_monthly_trend(_raw(sp, d)),
        "q_instrument_share": lambda sp, d: A.q_instrument_share(_raw(sp, d)),
        "q_cup_traceability": lambda sp, d: A.q_cup_traceability(_raw(sp, d)),
        "join_aid_measure": lambda sp, d: J.join_aid_measure(_clean(sp, d), _measures(sp, d)),
        "join_by_fiscal_code": lambda sp, d: J.join_by_fiscal_code(_clean(sp, d), S.entities(sp, d)),
        "join_by_fiscal_code_prefiltered": lambda sp, d: J.join_by_fiscal_code(_clean(sp, d), S.entities(sp, d), prefilter=True),
        "join_by_cup_bridge_prefiltered": lambda sp, d: J.join_by_cup_bridge(_clean(sp, d), S.cup_bridge(sp, d), prefilter=True),
        "join_by_cup_bridge": lambda sp, d: J.join_by_cup_bridge(_clean(sp, d), S.cup_bridge(sp, d)),
        "join_by_region": lambda sp, d: J.join_by_region(_clean(sp, d), S.territory(sp, d)),
    })
    q.update({
        "ingest_aid_xml": lambda sp, d: ingest_aid(sp, _aid_xml(sp, d)),
        "flatten_aid": lambda sp, d: ingest_aid(sp, _aid_xml(sp, d), statuses=(FL.OK, FL.YEAR_ZERO)),
        "reject_invalid_year": lambda sp, d: ingest_aid(sp, _aid_xml(sp, d), statuses=(FL.YEAR_ZERO,)),
        "quarantine_malformed": lambda sp, d: X.parse_counts(
            X.read_aid_xml(sp, _aid_xml(sp, d)), source=_source_month()),
        "select_files_by_year": lambda sp, d: ingest_aid(sp, _aid_xml(sp, d), years=FILE_YEARS),
        "ingest_measure_xml": lambda sp, d: C.conform_schema(ingest_measures(sp, _measure_xml(sp, d)),
                                                             MEASURE_SCHEMA),
        "flatten_measure": lambda sp, d: C.conform_schema(
            ingest_measures(sp, _measure_xml(sp, d), statuses=(FL.OK, FL.YEAR_ZERO)), MEASURE_SCHEMA),
        "conform_schema": lambda sp, d: C.conform_schema(
            ingest_measures(sp, _measure_xml(sp, d)).drop("link_aiuto").withColumn("extra", F.lit(1)),
            MEASURE_SCHEMA),
    })
    q.update({
        "dedup_keep_last": q_dedup_keep_last,
        "write_year_overwrite": q_write_year_overwrite,
        "upsert_append": q_upsert_append,
        "rebuild_years": q_rebuild_years,
        "rebuild_measures": q_rebuild_measures,
        "read_year": q_read_year,
        "read_all_years": q_read_all_years,
        "publish_layers": q_publish_layers,
        "publish_years": q_publish_years,
        "dq_min_rows": q_dq_min_rows,
        "dq_not_null": q_dq_not_null,
        "dq_primary_key": q_dq_primary_key,
        "run_signal": q_run_signal,
        "manifest_by_year": q_manifest_by_year,
        "manifest_index": q_manifest_index,
        "manifest_totals": q_manifest_totals,
        "manifest_measures": lambda sp, d: CT.manifest_measures(_measures(sp, d)),
        "file_summary": q_file_summary,
        "incremental_load": q_incremental_load,
        "versioned_overwrite": q_versioned_overwrite,
        "versioned_upsert": q_versioned_upsert,
        "versioned_rebuild": q_versioned_rebuild,
        "versioned_incremental_load": lambda sp, d: q_incremental_load(sp, d, versioned=True),
        "distinct_firms": q_distinct_firms,
        "manifest_refresh": q_manifest_refresh,
        "bucketed_dedup": q_bucketed_dedup,
        "mart_base": q_mart_base,
        "joinable_pairs": q_joinable_pairs,
        "footer_counts": q_footer_counts,
        "salvage_malformed": q_salvage_malformed,
        "ingest_prefixed_xml": q_ingest_prefixed,
    })

    def values(kind, *outs):
        def run(sp, d):
            t = TS.text_values(prepare(sp), d, kind)
            return t.select("l_orderkey", "l_linenumber", "testo", *[fn(F.col("testo")).alias(n) for n, fn in outs])
        return run

    def ym(i):
        return lambda c: T.year_month(c)[i]

    q.update({
        "scrub_control_chars": values("control", ("pulito", T.scrub_control_chars)),
        "repair_truncated_tags": values("tag", ("pulito", T.repair_truncated_tags)),
        "normalize_text": values("space", ("pulito", T.normalize_text)),
        "parse_amount": values("amount", ("importo", T.parse_amount)),
        "year_month": values("date", ("anno", ym(0)), ("mese", ym(1))),
    })
    return q
