"""Money arithmetic with results that do not depend on the engine.

Amounts are summed as ``decimal(28,8)`` into ``decimal(38,8)`` (exact, so the
result does not depend on the order rows arrive in), rounded as decimals, then
returned as double. Ratios are computed in double and rounded through
``decimal(38,8)`` so that half-way cases round the same way on every engine.

One rule for amounts that are no such number (NaN, infinite, 1e20 and over): they
count as missing, in sums and in the counts that means divide by, and
``unusable`` counts them. A sum beyond ``decimal(38,8)`` is missing as well.
Nothing raises.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

MONEY = "decimal(28,8)"
RATIO = "decimal(38,8)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return _c(c).try_cast(MONEY)


def total(c) -> Column:
    """Exact sum of an amount column (aggregate)."""
    return F.try_sum(money(c))


def rounded(dec: Column, digits: int = 0) -> Column:
    """ROUND of an exact decimal, as double."""
    return F.round(dec, digits).cast("double")


def mean(c) -> Column:
    """AVG of an amount column as double: exact sum / count of the amounts in it
    (aggregate)."""
    return total(c).cast("double") / F.nullif(F.count(money(c)), F.lit(0))


def unusable(c) -> Column:
    """How many amounts are present but no representable number (aggregate)."""
    return F.count_if(_c(c).isNotNull() & money(c).isNull())


def round_double(x: Column, digits: int) -> Column:
    """ROUND of a double. Zero digits round the double directly (half away from
    zero on every engine); more digits go through ``RATIO``, and what does not fit
    it is rounded as a double."""
    if digits == 0:
        return F.round(x, 0)
    return F.coalesce(F.round(x.try_cast(RATIO), digits).cast("double"), F.round(x, digits))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """ROUND(num * 100.0 / NULLIF(den, 0), digits) in double."""
    ratio = num.cast("double") * F.lit(100.0) / F.nullif(den.cast("double"), F.lit(0.0))
    return round_double(ratio, digits)


def share_of(raw_total: str, *partition: str, digits: int = 2) -> Column:
    """Share of an aggregated row's exact total within its partition:
    ``SUM(x)*100/SUM(SUM(x)) OVER (PARTITION BY ...)``. Runs on aggregated rows."""
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return pct(F.col(raw_total), F.try_sum(F.col(raw_total)).over(w), digits)
