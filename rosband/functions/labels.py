"""CASE-style labelling expressions (segment, region membership, product roll-up, product label)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_way(col: Column | str, members: Sequence, inside: str, outside: str) -> Column:
    """``CASE WHEN col IN (members) THEN inside ELSE outside END`` (null -> outside)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(list(members)), F.lit(inside)).otherwise(F.lit(outside))


def first_match(rules: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """Chained CASE: the first true predicate wins."""
    if not rules:
        return F.lit(default)
    expr = None
    for pred, label in rules:
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return expr.otherwise(F.lit(default))


def membership(col: Column | str, sets: Mapping[str, Sequence], default: str | None) -> Column:
    """Set-membership CASE: label of the first set containing the value."""
    c = F.col(col) if isinstance(col, str) else col
    return first_match([(c.isin(list(v)), k) for k, v in sets.items()], default)


def keyword_rollup(col: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Replace a name by a roll-up label when it contains a keyword (case-insensitive).

    Rules apply in order and the first match wins; a null name stays null.
    """
    c = F.col(col) if isinstance(col, str) else col
    low = F.lower(c)
    expr = None
    for keyword, label in rules:
        pred = low.contains(keyword.lower())
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return c if expr is None else expr.otherwise(c)


def product_label(product: Column | str, size: Column | str, fmt: Column | str, formats: Sequence[str]) -> Column:
    """``format product size`` for the listed formats, else ``product size``.

    ``concat`` (not ``concat_ws``): any null part makes the label null, so the
    row is later removed by the null filter, as in the analysed job.
    """
    p = F.col(product) if isinstance(product, str) else product
    s = F.col(size) if isinstance(size, str) else size
    f = F.col(fmt) if isinstance(fmt, str) else fmt
    sp = F.lit(" ")
    return F.when(f.isin(list(formats)), F.concat(f, sp, p, sp, s)).otherwise(F.concat(p, sp, s))
