"""Marts from counted rows equal the marts from the clean layer."""

import pytest

from aidspark.operators import clean as C
from aidspark.operators import lattice as LT
from aidspark.operators import marts as M
from aidspark.plans import layers as L
from aidspark.plans import storage as ST
from aidspark.sources import standin as S
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw(spark):
    from aidspark.session import scratch_dir
    path = scratch_dir(spark, "lattice-raw")
    ST.write_year_overwrite(S.aid_raw(spark, SF_SMALL), path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def written(spark, raw):
    from aidspark.session import scratch_dir
    path = scratch_dir(spark, "lattice-base")
    LT.base(C.clean_aid(raw)).write.partitionBy(LT.SET).parquet(path)
    return path


@pytest.mark.parametrize("name", [n for n in M.AID_MARTS])
def test_every_mart_is_a_grouping_of_the_base(spark, raw, written, name):
    fn = M.AID_MARTS[name]
    got = LT.mart(fn, spark.read.parquet(written))
    want = fn(C.clean_aid(raw))
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_the_base_scans_the_raw_layer_once(spark, raw, written):
    plan = LT.base(C.clean_aid(raw))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    plan = LT.mart(M.mart_per_regione, spark.read.parquet(written))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "PartitionFilters: [insieme" in plan.replace("isnotnull(insieme#", "insieme#") or "insieme" in plan


def test_sets_hold_only_what_their_marts_need(raw):
    assert LT.sets_for(L.AID_REGISTERED.values()) == ["imprese", "codici", "obiettivi", "sezioni"]
    assert LT.sets_for([M.mart_policy]) == ["obiettivi", "strumenti"]
    assert "strumento" not in LT.base(C.clean_aid(raw), ["obiettivi"]).columns


def test_nulls_in_the_columns_are_no_missing_columns(spark):
    clean = C.clean_aid(spark.createDataFrame(
        [(2020, None, "PMI", "f1", 1.0), (2020, "R", None, "f1", 2.0), (None, "R", "PMI", None, 4.0)],
        "anno int, regione_beneficiario string, tipo_beneficiario string, codice_fiscale_beneficiario string, elemento_aiuto double"))
    base = LT.base(clean)
    for fn in set(M.AID_MARTS.values()):
        assert sorted(map(repr, LT.mart(fn, base).collect())) == sorted(map(repr, fn(clean).collect())), fn.__name__


def test_a_layer_run_is_the_same_with_and_without_one_scan(spark, raw, tmp_dir):
    from aidspark.operators import quality as Q
    run = lambda one, out: L.run_layers(spark, raw, f"{tmp_dir}/{out}", C.clean_aid, L.AID_REGISTERED, Q.AID_CLEAN_RULES,
                                        Q.AID_REQUIRED_MARTS, Q.AID_MART_RULES, one_scan=one)
    a, b = run(True, "a"), run(False, "b")
    assert {n: m["rows"] for n, m in a["marts"].items()} == {n: m["rows"] for n, m in b["marts"].items()}
    for n in L.AID_REGISTERED:
        read = lambda x: sorted(map(repr, spark.read.parquet(f"{tmp_dir}/{x}/{n}").collect()))
        assert read("a") == read("b")
