"""Unit conversion rules: millilitres -> serving units, or volume := quantity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class UnitRule:
    """Products in ``products`` get ``volume / divisor``, or ``volume := quantity`` when ``divisor`` is None."""

    products: tuple[str, ...]
    divisor: float | None = None

    @staticmethod
    def per(products: Sequence[str], divisor: float) -> "UnitRule":
        return UnitRule(tuple(products), float(divisor))

    @staticmethod
    def as_quantity(products: Sequence[str]) -> "UnitRule":
        return UnitRule(tuple(products), None)


def apply_rules(product: Column, volume: Column, quantity: Column, rules: Sequence[UnitRule]) -> Column:
    """Apply rules in sequence: a product listed twice is converted twice."""
    out = volume
    for r in rules:
        if not r.products:
            continue
        new = quantity if r.divisor is None else out / F.lit(r.divisor)
        out = F.when(product.isin(list(r.products)), new).otherwise(out)
    return out
