"""Composite jobs: price bands (C5), average price (C6), report lists (C7)."""

from rosband.plans.avg_price import AvgStages, avg_price
from rosband.plans.price_bands import BandStages, price_bands

__all__ = ["AvgStages", "BandStages", "avg_price", "price_bands"]
