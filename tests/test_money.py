"""Sums, means and ratios of extreme amounts."""

from aidspark.functions import money as M
from pyspark.sql import functions as F


def _one(spark, values, *aggs):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return df.agg(*[a.alias(f"v{i}") for i, a in enumerate(aggs)]).first()


def test_digits_below_a_cent_add_up(spark):
    r = _one(spark, [0.004] * 1000, M.rounded(M.total("x"), 2), M.mean("x"))
    assert r.v0 == 4.0 and abs(r.v1 - 0.004) < 1e-12


def test_large_amounts_do_not_raise(spark):
    r = _one(spark, [1e12, 1e17, 1.0], M.rounded(M.total("x")))
    assert r.v0 == 1e17 + 1e12 + 1.0


def test_what_is_no_number_counts_as_missing_everywhere(spark):
    r = _one(spark, [5.0, float("nan"), float("inf"), float("-inf"), 1e25, None],
             M.rounded(M.total("x")), M.mean("x"), M.unusable("x"))
    assert (r.v0, r.v1, r.v2) == (5.0, 5.0, 4)


def test_ratios_of_any_size(spark):
    df = spark.createDataFrame([(5e10, 0.5), (1e12, 1e30), (1.0, 0.0)], "a double, b double")
    got = [r.p for r in df.select(M.pct(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == [1e13, 0.0, None]
    assert df.select(M.round_double(F.lit(1e40), 2).alias("v")).first().v == 1e40
