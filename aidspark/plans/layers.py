"""Layer runs: raw -> clean -> gates -> marts, each layer written once.

Row and NULL counts for the gates are observed while the clean layer is
written. When gates block (``fail_on_error``), the marts start after the gate
and read the written clean files; otherwise the clean write and the marts run
as concurrent jobs, the marts reading the raw Parquet through the clean
projection. In both cases every mart prunes to the few columns it needs and
every job's lineage starts at Parquet files.

With ``one_scan`` the marts read the raw layer once for all: its rows are
counted for the marts' sets of columns (``operators.lattice``), written to the
scratch folder, and every mart is grouped from there.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aidspark.operators import clean as C
from aidspark.operators import lattice as LT
from aidspark.operators import marts as M
from aidspark.operators import quality as Q
from aidspark.plans.storage import ZSTD, path_bytes
from aidspark.session import scratch_dir

# --- fixed values: the marts each dataset configuration registers -------------
AID_REGISTERED = {
    "mart_aiuti_per_regione": M.mart_per_regione,
    "mart_aiuti_per_procedimento": M.mart_per_procedimento,
    "mart_aiuti_top_beneficiari": M.mart_top_beneficiari,
    "mart_aiuti_per_obiettivo": M.mart_per_obiettivo,
    "mart_aiuti_per_strumento": M.mart_per_strumento,
    "mart_aiuti_tipo_beneficiario": M.mart_tipo_beneficiario,
    "mart_aiuti_settore_regione": M.mart_settore_regione,
}
AID_REFACTORED = {
    "mart_territorio": M.mart_territorio,
    "mart_policy": M.mart_policy,
    "mart_settori": M.mart_settori,
    "mart_top": M.mart_top,
}
MEASURE_REGISTERED = dict(M.MEASURE_MARTS)


def _clean_gates(df: DataFrame, path: str, stats: dict, rules: dict) -> list[tuple[str, bool]]:
    """Gates of the clean layer from what its write observed; only a primary key
    reads the written files again."""
    out = [("min_rows", stats["*"] >= rules.get("min_rows", 0))]
    out += [(f"not_null {c}", not stats[c]) for c in rules.get("not_null", [])]
    if "required_columns" in rules:
        out.append(("required_columns", set(rules["required_columns"]) <= set(df.columns)))
    if "primary_key" in rules:
        written = df.sparkSession.read.parquet(path)
        out.append(("primary_key", not Q.dq_primary_key(written, rules["primary_key"]).head(1)))
    return out


def _gates_of_mart(spark: SparkSession, path: str, name: str, rows: int, rule: dict) -> list[tuple[str, bool]]:
    """Gates of one written mart: rows observed, columns and key of its files."""
    out, written = [], spark.read.parquet(path) if rule else None
    if "min_rows" in rule:
        out.append((f"min_rows {name}", rows >= rule["min_rows"]))
    if "required_columns" in rule:
        out.append((f"required_columns {name}", set(rule["required_columns"]) <= set(written.columns)))
    if "primary_key" in rule:
        out.append((f"primary_key {name}", not Q.dq_primary_key(written, rule["primary_key"]).head(1)))
    return out


def _mart_gates(marts: dict, required: list[str], rules: dict) -> list[tuple[str, bool]]:
    """Tables that must be there, and the gates found as each mart was written."""
    out = [(f"table {name}", name in marts) for name in required]
    for name in rules:
        out += marts[name]["gates"] if name in marts else [(f"rules {name}", False)]
    return out


def _write_counted(df: DataFrame, path: str, partition_by: str | None = None,
                   not_null: list[str] = ()) -> dict:
    """Write ``df``; row count and NULL counts of ``not_null`` columns are
    observed during the write (gates V2/V3 without a second scan)."""
    obs = Observation("rows")
    metrics = [F.count(F.lit(1)).alias("*")] + [
        F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in not_null]
    w = df.observe(obs, *metrics).write.mode("overwrite").options(**ZSTD)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return {k: int(v or 0) for k, v in obs.get.items()}


def run_layers(spark: SparkSession, raw: DataFrame, out_dir: str,
               clean_fn: Callable[[DataFrame], DataFrame],
               marts: dict[str, Callable[[DataFrame], DataFrame]],
               rules: dict, required_marts: list[str] = (), mart_rules: dict | None = None,
               partition_by: str | None = "anno", fail_on_error: bool = False, parallel: int = 8,
               one_scan: bool = False) -> dict:
    """Write the clean layer and every mart, run the gates; return rows, seconds
    and gates per step.

    With ``fail_on_error`` the clean layer is written and gated first (row
    count and NULL counts observed during the write), and the marts then read
    the written clean files. Without it, gates do not block, so the clean
    write and the marts run as concurrent jobs (up to ``parallel`` submitted
    from driver threads) and each mart reads the raw layer through the clean
    projection, pruned to its own columns. Either way every job's lineage
    starts at Parquet files, so a lost executor only recomputes its splits.

    ``one_scan``: marts that are groupings of the lattice's sets are made from its
    counted rows, for which the raw layer is scanned once."""
    t0 = time.time()
    clean_path = f"{out_dir}/clean"
    report = {"clean_path": clean_path, "marts": {}}
    not_null = rules.get("not_null", [])
    raw_rows = Observation("raw")
    counted = raw.observe(raw_rows, F.count(F.lit(1)).alias("n"))

    def write_clean():
        clean = clean_fn(counted)
        stats = _write_counted(clean, clean_path, partition_by, not_null)
        gates = _clean_gates(clean, clean_path, stats, rules)
        report.update({"raw_rows": int(raw_rows.get["n"] or 0), "clean_rows": stats["*"],
                       "clean_nulls": {c: stats[c] for c in not_null},
                       "clean_sec": round(time.time() - t0, 3), "clean_gates": gates})
        report["clean_gates_failed"] = bad = [name for name, ok in gates if not ok]
        if bad and fail_on_error:
            raise Q.QualityError(f"{len(bad)} gate(s) of the clean layer failed: {bad}")

    def one(name, fn, source):
        t = time.time()
        rows = _write_counted(fn(source), f"{out_dir}/{name}")["*"]
        sec = round(time.time() - t, 3)
        # gated at once, beside the other marts' jobs
        gates = _gates_of_mart(spark, f"{out_dir}/{name}", name, rows, (mart_rules or {}).get(name, {}))
        report["marts"][name] = {"rows": rows, "sec": sec, "gates": gates}

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        if fail_on_error:
            write_clean()
            source = spark.read.parquet(clean_path)
            futures = [pool.submit(one, n, fn, source) for n, fn in marts.items()]
        else:
            source = clean_fn(raw)
            # The clean write is submitted first, as it takes longest.
            futures = [pool.submit(write_clean)]
            counted_marts = {n: fn for n, fn in marts.items() if one_scan and fn in LT.SETS_OF}
            futures += [pool.submit(one, n, fn, source) for n, fn in marts.items() if n not in counted_marts]
            if counted_marts:
                path = scratch_dir(spark, "mart-base")
                (LT.base(source, LT.sets_for(counted_marts.values())).write.options(**ZSTD)
                 .partitionBy(LT.SET).parquet(path))
                report["base_sec"] = round(time.time() - t0, 3)
                base = spark.read.parquet(path)
                futures += [pool.submit(one, n, lambda b, fn=fn: LT.mart(fn, b), base) for n, fn in counted_marts.items()]
        for f in futures:
            f.result()
    report["mart_rows"] = sum(m["rows"] for m in report["marts"].values())
    gates = _mart_gates(report["marts"], required_marts, mart_rules or {})
    report["mart_gates"] = gates
    report["mart_gates_failed"] = bad = [name for name, ok in gates if not ok]
    report["total_sec"] = round(time.time() - t0, 3)  # gates included
    if bad and fail_on_error:
        raise Q.QualityError(f"{len(bad)} gate(s) of the marts failed: {bad}")
    report["output_bytes"] = {"clean": path_bytes(spark, clean_path),
                              "mart": sum(path_bytes(spark, f"{out_dir}/{n}") for n in marts)}
    return report



def run_aid(spark: SparkSession, raw: DataFrame, out_dir: str, marts=None,
            year: int | None = None) -> dict:
    """Aid dataset: gates report but do not block (no fail_on_error in its
    config). With ``year`` the run covers that year only (the raw scan is
    pruned to its partition) and writes under ``{out_dir}/{year}``, as the
    register publishes per-year layers."""
    if year is not None:
        raw, out_dir = raw.where(F.col("anno") == year), f"{out_dir}/{year}"
    return run_layers(spark, raw, out_dir, C.clean_aid, marts or AID_REGISTERED,
                      Q.AID_CLEAN_RULES, Q.AID_REQUIRED_MARTS, Q.AID_MART_RULES, one_scan=True)


def run_measures(spark: SparkSession, raw: DataFrame, out_dir: str, fail_on_error: bool = True) -> dict:
    """Measure dataset: gates block, as its configuration says."""
    return run_layers(spark, raw, out_dir, C.clean_measure, MEASURE_REGISTERED,
                      Q.MEASURE_CLEAN_RULES, Q.MEASURE_REQUIRED_MARTS, Q.MEASURE_MART_RULES,
                      partition_by=None, fail_on_error=fail_on_error)


def signal(spark: SparkSession, report: dict, dataset: str, year: int | None = None) -> DataFrame:
    """V7: the run signal of a layer run: per layer (raw, clean, mart) rows,
    bytes (null for raw, which the run only reads), gates run and passed, quality
    score, status, and the run's duration. Built from the run report (counts
    observed during the writes), so it reads no data."""
    rows = []
    for layer in ("raw", "clean", "mart"):
        gates = report.get(f"{layer}_gates", [])
        passed = sum(ok for _, ok in gates)
        rows.append((dataset, year, layer, report[f"{layer}_rows"], report["output_bytes"].get(layer),
                     len(gates), passed, 100 * passed // len(gates) if gates else 100,
                     "SUCCESS" if passed == len(gates) else "WARNING", float(report["total_sec"])))
    return spark.createDataFrame(rows, "dataset string, anno int, layer string, righe bigint, byte bigint, "
                                       "controlli bigint, superati bigint, punteggio_qualita int, "
                                       "stato string, durata_sec double")
