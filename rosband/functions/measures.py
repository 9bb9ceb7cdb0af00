"""Arithmetic on measures: unit price, rate of sale, shares.

Spark 4 runs with ANSI mode on, where ``x / 0.0`` raises; ``try_divide``
returns null instead, which later predicates treat like the NaN of pandas.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def unit_price(value: Column | str = "value", quantity: Column | str = "quantity") -> Column:
    return F.try_divide(_c(value), _c(quantity))


def rate_of_sale(total: Column | str, outlets: Column | str) -> Column:
    return F.try_divide(_c(total), _c(outlets).cast("double"))


def share(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(_c(part), _c(whole))


SHARE_DECIMALS = 12


def share_key(s: Column | str, decimals: int = SHARE_DECIMALS) -> Column:
    """A share as an integer count of 1e-12 units.

    Shares are ratios of floating sums whose last bits depend on summation
    order, so two partners with equal volume can differ by one ulp.  Ranking,
    tie detection and the threshold test use this key: shares equal to 12
    decimals are equal.
    """
    return F.floor(_c(s) * F.lit(float(10**decimals)) + F.lit(0.5))


def share_limit(limit: float, decimals: int = SHARE_DECIMALS) -> int:
    import math

    return math.floor(limit * 10**decimals + 0.5)
