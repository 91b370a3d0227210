"""Keep-last deduplication on a key (K1).

``max_by(struct(row), order)`` per key instead of ``row_number`` over a
window: it is an ordinary aggregate with a map-side partial step, so a key that
holds a third of all rows is reduced to one row per input partition before the
shuffle, and no task ever sorts a whole key group. ``dropDuplicates`` is not
used: it keeps an arbitrary row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_keep_last(df: DataFrame, key: Sequence[str], order: str | Column,
                    keep_order: bool = False) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order`` (the last to
    arrive). '' keys take part like any other value. ``order`` must be a total
    order within a key (e.g. file, split offset, record position)."""
    order_col = F.col(order) if isinstance(order, str) else order
    order_name = order if isinstance(order, str) else "_order"
    payload = [c for c in df.columns if c not in key and (keep_order or c != order_name)]
    g = (df.withColumn("_order", order_col)
         .groupBy(*key)
         .agg(F.max_by(F.struct(*payload), F.col("_order")).alias("_last")))
    out = g.select(*key, *[F.col(f"_last.{c}").alias(c) for c in payload])
    return out.select(*[c for c in df.columns if c in out.columns])
