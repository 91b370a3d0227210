"""Bucketed tables without shuffles of the stored side (K1, K3, V4, J1, J3), manifests kept
up by file (D1, D2), Bloom filters of entity joins (J3, J4)."""

import uuid

import pytest
from pyspark.sql import functions as F

from aidspark.operators import catalog as CT
from aidspark.operators import joins as J
from aidspark.operators.dedup import dedup_keep_last
from aidspark.plans import bucketed as B
from aidspark.plans import manifest as MF
from aidspark.plans import storage as ST
from tests.test_storage import _rows

KEY = ["cor", "id_componente", "cod_strumento"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def table(spark, tmp_dir):
    rows = _rows(spark, [(str(k % 60), "a", "x", 2020, k, f"v{k}") for k in range(150)])
    return B.write_bucketed(rows, f"t{uuid.uuid4().hex[:8]}", tmp_dir + "/t", KEY, 4)


def test_grouping_by_the_key_needs_no_exchange(table):
    kept = B.keep_last(table, KEY, "_arrival")
    assert "Exchange" not in plan_of(kept) and "Bucketed: true" in plan_of(kept)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, dedup_keep_last(table.where("true"), KEY, "_arrival").collect()))
    twice = B.repeated_keys(table, KEY)
    assert "Exchange" not in plan_of(twice) and twice.count() == 60


def test_an_upsert_shuffles_only_the_batch(spark, table, tmp_dir):
    name = f"t{uuid.uuid4().hex[:8]}"
    once = B.write_bucketed(B.keep_last(table, KEY, "_arrival", keep_order=True), name, tmp_dir + "/once", KEY, 4)
    fresh = _rows(spark, [(str(k), "a", "x", 2020, 900 + k, "new") for k in (3, 4, 99)])
    keys = fresh.select(*KEY).repartition(4, *KEY)
    plan = plan_of(once.join(keys.hint("merge"), KEY, "left_anti"))
    assert plan.count("Exchange") == 1
    got = B.upsert(spark, name, f"t{uuid.uuid4().hex[:8]}", tmp_dir + "/next", fresh, KEY, 4)
    who = {r.cor: r.soggetto_concedente for r in got.collect()}
    assert len(who) == got.count() == 61 and {c for c, w in who.items() if w == "new"} == {"3", "4", "99"}


def test_a_join_on_the_key_needs_no_exchange(spark, table, tmp_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = B.write_bucketed(table.select(*KEY, F.lit(1).alias("flag")), f"t{uuid.uuid4().hex[:8]}", tmp_dir + "/o", KEY, 4)
        assert "Exchange" not in plan_of(table.join(other, KEY))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_manifest_reads_only_changed_files(spark, tmp_dir):
    layer, root = tmp_dir + "/layer", tmp_dir + "/state"
    rows = lambda who: _rows(spark, [(str(k), "a", "x", 2020 + k % 3, k, who) for k in range(30)])
    same = lambda: sorted(map(repr, MF.manifest(spark, root).collect())) == sorted(
        map(repr, CT.manifest_by_year(spark.read.parquet(layer)).collect()))
    ST.write_year_overwrite(rows("a"), layer)
    assert len(MF.refresh(spark, layer, root)) >= 3 and same()
    assert MF.refresh(spark, layer, root) == []
    ST.write_year_overwrite(rows("b").where("cor <> '1'"), layer, years=[2021])
    read = MF.refresh(spark, layer, root)
    assert read and all("anno=2021" in f for f in read) and same()
    ST.write_year_overwrite(rows("b").limit(0), layer, years=[2022])
    assert MF.refresh(spark, layer, root) == [] and same()
    assert {r.anno for r in MF.manifest(spark, root).collect()} == {2020, 2021}


def test_a_refresh_that_died_is_done_again(spark, tmp_dir):
    layer, root = tmp_dir + "/layer", tmp_dir + "/state"
    ST.write_year_overwrite(_rows(spark, [("1", "a", "x", 2020, 1, "v")]), layer)
    MF.state(spark, root).write.parquet(f"{root}/state1")
    ST._delete(spark, f"{root}/state1/_SUCCESS")
    assert len(MF.refresh(spark, layer, root)) == 1 and MF.manifest(spark, root).first().righe == 1


def test_absent_firms_are_filtered_before_the_shuffle(spark, tmp_dir):
    """Spark's run-time Bloom filter, by default from 10 GB of aid on, here from 0."""
    _rows(spark, [(str(k), "a", "x", 2020, k, "v") for k in range(50)]).drop("_arrival").withColumn(
        "codice_fiscale_beneficiario", F.col("cor")).write.parquet(tmp_dir + "/aid")
    spark.createDataFrame([("7", "p"), ("8", "q")], "codice_fiscale string, kind string").write.parquet(tmp_dir + "/ent")
    conf = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        aid, ent = spark.read.parquet(tmp_dir + "/aid"), spark.read.parquet(tmp_dir + "/ent").where("kind = 'p'")
        out = J.join_by_fiscal_code(aid, ent, prefilter=True)
        plan = plan_of(out)
        assert "might_contain" in plan
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, J.join_by_fiscal_code(aid, ent).collect()))
        assert [r.codice_fiscale for r in out.collect()] == ["7"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
