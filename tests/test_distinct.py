"""Firm numbers and mergeable firm bitmaps against COUNT(DISTINCT)."""

import itertools

from pyspark.sql import functions as F

from aidspark.operators import distinct as D


def rows(spark):
    data = [(y, r, f"f{(i * 7919 + y) % 700}" if i % 11 else None) for i, (y, r) in enumerate(
        itertools.product(range(2019, 2024), ["N", "S", None] * 200))]
    return spark.createDataFrame(data, "anno int, regione string, firm string").repartition(5)


def test_numbers_are_dense_and_stay(spark):
    df = rows(spark)
    first = D.firm_numbers(df.where("anno < 2022"), "firm").cache()
    got = {r.firm: r.numero for r in first.collect()}
    assert sorted(got.values()) == list(range(len(got))) and None not in got
    every = {r.firm: r.numero for r in D.firm_numbers(df, "firm", known=first).collect()}
    assert {f: every[f] for f in got} == got and sorted(every.values()) == list(range(len(every)))
    assert len(every) == df.select("firm").distinct().count() - 1


def test_counts_of_every_grain_follow_from_the_finest(spark):
    df = rows(spark)
    bitmaps = D.firm_bitmaps(df, D.firm_numbers(df, "firm"), "firm", ["anno", "regione"]).cache()
    for dims in (["anno", "regione"], ["anno"], ["regione"], []):
        want = {tuple(r) for r in df.groupBy(*dims).agg(F.countDistinct("firm")).collect()}
        assert {tuple(r) for r in D.firm_counts(bitmaps, dims).collect()} == want


def test_a_year_is_replaced_without_its_neighbours(spark):
    df = rows(spark)
    numbers = D.firm_numbers(df, "firm").cache()
    old = D.firm_bitmaps(df, numbers, "firm", ["anno"])
    fresh = df.where("anno = 2020").withColumn("firm", F.when(F.hash("firm") % 2 == 0, F.col("firm")))
    merged = old.where("anno <> 2020").unionByName(D.firm_bitmaps(fresh, numbers, "firm", ["anno"]))
    want = df.where("anno <> 2020").unionByName(fresh).agg(F.countDistinct("firm")).first()[0]
    assert D.firm_counts(merged, []).first()[0] == want


def test_numbers_over_several_pieces(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), F.concat(F.lit("f"), F.col("id")).alias("firm"))
    bitmaps = D.firm_bitmaps(df, D.firm_numbers(df, "firm"), "firm", ["g"]).cache()
    assert bitmaps.select("pezzo").distinct().count() == 4
    assert {r.g: r.imprese for r in D.firm_counts(bitmaps, ["g"]).collect()} == {0: 33_334, 1: 33_333, 2: 33_333}
    assert D.firm_counts(bitmaps, []).first()[0] == 100_000


def test_no_rows(spark):
    df = rows(spark).limit(0)
    assert D.firm_counts(D.firm_bitmaps(df, D.firm_numbers(df, "firm"), "firm", ["anno"]), ["anno"]).collect() == []
