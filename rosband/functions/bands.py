"""Band assignment: the first quantile whose edge is >= the price."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band_of(price: Column | str, edges: Column | str, quantiles: Sequence[float]) -> Column:
    """``CASE WHEN price <= edges[0] THEN q0 WHEN price <= edges[1] THEN q1 ... END``.

    Generated from ``quantiles``; a price above every edge gets null.
    """
    p = F.col(price) if isinstance(price, str) else price
    e = F.col(edges) if isinstance(edges, str) else edges
    expr = None
    for i, q in enumerate(quantiles):
        pred = p <= e.getItem(i)
        lab = F.lit(float(q))
        expr = F.when(pred, lab) if expr is None else expr.when(pred, lab)
    return expr


def percentile_array(quantiles: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(q)) for q in quantiles])
