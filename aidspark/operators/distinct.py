"""Exact distinct firms that merge (M1, M4, M6-M10, Q1, Q2, Q5 at coarser grains).

Firms get dense numbers once. The firms of a group are then a bitmap, kept as
one 4 KB piece for each 32,768 numbers in which the group has any, and bitmaps
merge by OR: the counts of years, regions or of everything follow from finer
ones, and a new year adds its own bitmaps, without firms being shuffled again.
Counts are exact, equal to ``COUNT(DISTINCT)``.

A piece costs 4 KB however few firms it holds, so bitmaps pay for groups with
many firms (years, regions, procedures); fine grains such as sector x region
are better served by a plain distinct count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NUMBER, PIECE, BITS = "numero", "pezzo", "bit"
#: Firms that one task numbers.
BLOCK_FIRMS = 200_000


def firm_numbers(rows: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``key, numero`` of every value of ``key`` that is not null: numbers from 0
    without gaps. ``known``: numbers given before, which stay; new values follow.

    Values are dealt to blocks by their hash and numbered there, from the sum of
    the blocks before. The result follows from the values alone, but it is to be
    written once and read back."""
    fresh = rows.where(F.col(key).isNotNull()).select(key).distinct()
    first = 0
    if known is not None:
        fresh = fresh.join(known.select(key), key, "left_anti")
        first = known.agg((F.max(NUMBER) + 1).alias("n")).first()["n"] or 0
    blocks = max(8, math.ceil((rows.agg(F.approx_count_distinct(key)).first()[0] or 0) / BLOCK_FIRMS))
    dealt = fresh.withColumn("_b", F.pmod(F.xxhash64(key), F.lit(blocks)))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    base = dealt.groupBy("_b").agg(F.count("*").alias("_c")).select("_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))
    at = F.row_number().over(Window.partitionBy("_b").orderBy(key))
    new = (dealt.withColumn("_at", at).join(base, "_b")
           .select(key, (F.lit(first) + F.col("_base") + F.col("_at") - 1).cast("bigint").alias(NUMBER)))
    return new if known is None else known.select(key, NUMBER).unionByName(new)


def firm_bitmaps(rows: DataFrame, numbers: DataFrame, key: str, dims: Sequence[str]) -> DataFrame:
    """``dims, pezzo, bit``: the firms of each group. Pairs of group and firm are
    told apart before firms meet their numbers."""
    pairs = rows.where(F.col(key).isNotNull()).select(*dims, key).distinct().join(numbers.select(key, NUMBER), key)
    # both functions count from 1
    number = F.col(NUMBER) + 1
    return (pairs.select(*dims, F.bitmap_bucket_number(number).alias(PIECE), F.bitmap_bit_position(number).alias("_p"))
            .groupBy(*dims, PIECE).agg(F.bitmap_construct_agg("_p").alias(BITS)))


def merged(bitmaps: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups: those of fewer ``dims``, by OR."""
    return bitmaps.groupBy(*dims, PIECE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def firm_counts(bitmaps: DataFrame, dims: Sequence[str], alias: str = "imprese") -> DataFrame:
    """``dims`` and the number of firms, of bitmaps of that grain or finer ones
    that are merged first."""
    at_grain = bitmaps if set(bitmaps.columns) == {*dims, PIECE, BITS} else merged(bitmaps, dims)
    return at_grain.groupBy(*dims).agg(F.sum(F.bitmap_count(BITS)).cast("bigint").alias(alias))
