"""Rate of sale: weekly sums and distinct outlets, period means, band counts.

Distinct outlets are exact (``operators/numbers``): an outlet's rows of an item meet in one task, which holds one set of cells
per outlet; a hot cell is spread over all tasks.  Sums per date and per partner come from one pass with map-side aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosband.functions.measures import rate_of_sale
from rosband.operators.bands import cell_number, member_places
from rosband.operators.joins import materialize
from rosband.operators.numbers import (
    BITS,
    WORD,
    cell_masks,
    counted_masks,
    gathered,
    members_per_cell,
    set_size,
    tasks_for,
)
from rosband.operators.rollup import CELL_ID, label_names
from rosband.schema import DimSpec


KIND = "__kind"
DATE_ROWS, PARTNER_ROWS, ALL_DATES = 0, 1, 1


def two_grains(rows: DataFrame, keys: Sequence[str], dates: Sequence[str], partner: str, measures: Sequence[str]) -> DataFrame:
    """Measure sums per key and date (``__kind`` 0) and per key and partner (``__kind`` 1) from one pass over the rows.

    ``GROUPING SETS ((keys, dates), (keys, partner))``: one shuffle with map-side partial aggregation for both sets.
    """
    agg = rows.groupingSets([[*keys, *dates], [*keys, partner]], *keys, *dates, partner).agg(
        *[F.sum(m).alias(f"sum_{m}") for m in measures],
        F.grouping(partner).alias("__g"),
    )
    kind = F.when(F.col("__g") == 1, F.lit(DATE_ROWS)).otherwise(F.lit(PARTNER_ROWS))
    return agg.withColumn(KIND, kind).drop("__g")


def date_rows(grain: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Sums per ``keys`` (which include the date)."""
    return grain.where(F.col(KIND) == DATE_ROWS).select(*keys, *[f"sum_{m}" for m in metrics])


def partner_rows(grain: DataFrame, keys: Sequence[str], partner: str, metric: str) -> DataFrame:
    """Partner volumes per key (``dp_volume``), already aggregated."""
    return grain.where(F.col(KIND) == PARTNER_ROWS).select(*keys, partner, F.col(f"sum_{metric}").alias("dp_volume"))


def outlet_sets(
    rows: DataFrame,
    items: Sequence[str],
    dates: Sequence[str],
    outlet: str,
    partner: str,
    bits: Sequence[Column],
    n_bits: int,
    n_rows: int,
) -> DataFrame:
    """How many outlets of an item are in the same cells: per date (``__kind`` 0), and over all dates (``__kind`` 1).

    ``bits`` are the numbers of a row's cells; ``n_rows`` decides the number of tasks.  The rows move once, by item and outlet.
    """
    r = rows.where(F.col(outlet).isNotNull() & F.col(partner).isNotNull())
    masked = cell_masks(r, [*items, *dates, outlet], bits, n_bits)
    masked = masked.repartition(tasks_for(n_rows, r.sparkSession), *items, outlet)
    daily = gathered(masked, [*items, *dates, outlet], n_bits)
    # from the rows and not from the dates' sets: an outlet has few rows of an item and date, so these are hardly fewer
    whole = counted_masks(gathered(masked, [*items, outlet], n_bits), items, n_bits)
    daily = counted_masks(daily, [*items, *dates], n_bits).withColumn(KIND, F.lit(DATE_ROWS))
    return daily.unionByName(whole.withColumn(KIND, F.lit(ALL_DATES)), allowMissingColumns=True)


def outlets_of(sets: DataFrame, kind: int, items: Sequence[str], cells: DataFrame, keys: Sequence[str], n_bits: int, name: str) -> DataFrame:
    """Distinct outlets per ``keys`` from ``outlet_sets``; ``cells`` has the key columns of each bit (``__bit``)."""
    counted = members_per_cell(sets.where(F.col(KIND) == kind), items, n_bits, "__bit", name)
    return counted.join(cells, "__bit").select(*keys, name)


def outlets_per_cell(
    rows: DataFrame, items: Sequence[str], outlet: str, spec: DimSpec, cells: DataFrame, pairs: int, name: str = "outlet_count"
) -> DataFrame:
    """Distinct outlets per item and cell.  ``cells`` (cell id and labels) are those of the rows, ``pairs`` says how many
    pairs of a row and a cell there are: it decides the number of tasks."""
    names = label_names(rows, spec)
    rows, places, found = member_places(rows, spec, materialize(cells))
    at = [F.col(f"__place{i}") for i in range(len(found))]
    numbered = materialize(places.select(cell_number(at, found).alias("__bit"), CELL_ID, *names))
    own = [[F.col(c) if c else F.lit(0) for c in axis.columns] for axis in found]
    n_bits = prod(axis.size for axis in found)
    masked = cell_masks(rows, [*items, outlet], [cell_number(x, found) for x in product(*own)], n_bits)
    # a row has at least one cell of every dimension and its roll-up, where these are kept
    masked = masked.repartition(tasks_for(pairs // max(1, 2 ** len(found)), rows.sparkSession), *items, outlet)
    counted = counted_masks(gathered(masked, [*items, outlet], n_bits), items, n_bits)
    return members_per_cell(counted, items, n_bits, "__bit", name).join(numbered, "__bit").drop("__bit")


def weekly_ros(sums: DataFrame, outlets: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Per key (which includes the date): ``sum_<m>``, ``outlets`` and ``<m>_ros = sum / outlets``.

    Both frames have one row per key.  They are put together by grouping: the band of a key may be null.
    """
    both = sums.unionByName(outlets, allowMissingColumns=True)
    agg = both.groupBy(*keys).agg(*[F.sum(f"sum_{m}").alias(f"sum_{m}") for m in metrics], F.sum("outlets").alias("outlets"))
    return agg.withColumns({f"{m}_ros": rate_of_sale(f"sum_{m}", "outlets") for m in metrics})


def period_ros(weekly: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Unweighted mean of the weekly ROS over the weeks present for the key."""
    return weekly.groupBy(*keys).agg(*[F.avg(f"{m}_ros").alias(f"{m}_ros") for m in metrics])


def merged_sets(grain: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of the sets of a key, word by word."""
    return grain.groupBy(*keys, WORD).agg(F.bit_or(BITS).alias(BITS))


def distinct_outlets(sets: DataFrame, keys: Sequence[str], name: str = "outlet_count") -> DataFrame:
    """Distinct outlets per key, from sets with one row per key and word."""
    return sets.groupBy(*keys).agg(set_size().alias(name))
