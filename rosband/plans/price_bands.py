"""Price banding and rate of sale per band.

For every cell (period x item x region/segment member, including the
all-region / all-segment roll-ups):

1. exact price quantiles per cell and *date* are the band edges of that week;
2. every sale row is put in the first band whose edge (same cell, same date)
   is >= its price;
3. per band: weekly sums and distinct outlets give a weekly rate of sale,
   averaged (unweighted) over the weeks in which the band is non-empty;
4. per band over the whole period: distinct outlets, distinct data partners and
   the data partners' shares of volume with the unique largest partner;
5. the band price is the mean over the weeks of the cell's edge;
6. cells are published only if they pass the disclosure rule.

Plan shape: edges are selected by rank; bucket totals are rolled up from combinations of members, and rows are repeated only
for the cells that want their bucket (prices are counted first where they repeat).  Rows look their cells' edges up by place,
once, and are written with their bands.  From these, summed per combination of members and bands and then expanded, one
grouping-sets aggregate gives the sums; outlets are counted by the set of bands that each is in.  Each stage is built when it
is asked for: the edges, the coded rows, their grains and what reads them write their intermediates then, other stages stay lazy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosband.functions.measures import unit_price
from rosband.operators.bands import Placed, band_prices, counted_prices, edges_of_cells, place_edges
from rosband.operators.disclosure import partner_shares, partner_summary, suppress
from rosband.operators.joins import materialize
from rosband.operators.rollup import CELL_ID, Cells, carried, expand_cells, expand_items
from rosband.operators.ros import (
    ALL_DATES,
    DATE_ROWS,
    date_rows,
    outlet_sets,
    outlets_of,
    partner_rows,
    period_ros,
    two_grains,
    weekly_ros,
)
from rosband.schema import DEFAULT_METRICS, DEFAULT_QUANTILES, Columns, DimSpec, Thresholds, require_columns


def with_price(data: DataFrame, cols: Columns = Columns()) -> DataFrame:
    return data.withColumn(cols.price, unit_price(cols.value, cols.quantity))


@dataclass
class BandStages:
    """The stages of the price-band job for prepared rows; every stage is a property."""

    prices: DataFrame
    quantiles: list[float]
    metrics: list[str]
    dims: DimSpec
    cols: Columns
    thresholds: Thresholds
    tie_policy: str
    share_metric: str

    @property
    def measures(self) -> list[str]:
        return list(dict.fromkeys([*self.metrics, self.share_metric]))

    @property
    def _members(self) -> list[str]:
        return [c for c in dict.fromkeys([*self.dims.regions, *self.dims.segments]) if c in self.prices.columns]

    @property
    def _carry(self) -> list[str]:
        c = self.cols
        carry = [c.date, c.period, c.outlet, c.data_partner, c.price, "product_type", "product", *self.measures, *self._members]
        return list(dict.fromkeys(carry))

    @cached_property
    def cells(self) -> Cells:
        return expand_cells(self.prices.select(*self._carry), self.dims, self._carry)

    @property
    def labelled(self) -> DataFrame:
        return self.cells.df

    @property
    def cell_keys(self) -> list[str]:
        return [self.cols.period, "product_type", "product", *self.cells.keys]

    @property
    def date_keys(self) -> list[str]:
        return [self.cols.date, *self.cell_keys]

    @property
    def band_keys(self) -> list[str]:
        return [*self.cell_keys, "percentile"]

    @cached_property
    def edges(self) -> DataFrame:
        """Edges of every cell and date, from rows that are not expanded into their cells."""
        c = self.cols
        items = [c.date, *self._items]
        counted = counted_prices(self.prices, [*items, *self._members], c.price)
        return materialize(edges_of_cells(counted, self.dims, self._members, items, self.quantiles, c.price))

    @cached_property
    def band_prices(self) -> DataFrame:
        return band_prices(self.edges, self.cell_keys, self.quantiles)

    @property
    def _items(self) -> list[str]:
        return [self.cols.period, "product_type", "product"]

    @cached_property
    def _placed(self) -> Placed:
        """Rows with the edges of their date and item, not expanded."""
        return place_edges(self.prices.select(*self._carry), self.dims, self.edges, [self.cols.date, *self._items])

    @cached_property
    def _coded(self) -> DataFrame:
        """Rows with the bands of their cells, not expanded, written: bands, sums and outlet sets read them."""
        return materialize(self._placed.coded(self._carry, self.quantiles, self.cols.price))

    @cached_property
    def banded(self) -> DataFrame:
        keep = carried(self.prices, self.dims, self._carry)
        return self._placed.expanded(self._coded, keep, self.quantiles, self.cells.labels)

    @cached_property
    def grain(self) -> DataFrame:
        """Sums per band and date, and partner volumes per band, written: three statistics read them.

        Rows of the same members and bands are summed before they are expanded into their cells."""
        c = self.cols
        r = self._coded.where(F.col(c.outlet).isNotNull() & F.col(c.data_partner).isNotNull())
        keep = [c.date, *self._items, c.data_partner]
        summed = r.groupBy(*keep, *self._members, "__bits").agg(*[F.sum(m).alias(m) for m in self.measures])
        rows = self._placed.expanded(summed, [*keep, *self.measures], self.quantiles, self.cells.labels)
        return materialize(two_grains(rows, self.band_keys, [c.date], c.data_partner, self.measures))

    @property
    def _n_bits(self) -> int:
        return self._placed.n_cells * (len(self.quantiles) + 2)

    @cached_property
    def _sets(self) -> DataFrame:
        """How many outlets are in the same bands, per date and over all dates, written: three counts read them."""
        c, rows = self.cols, self._coded
        bits = self._placed.bits(self.quantiles)
        return materialize(outlet_sets(rows, self._items, [c.date], c.outlet, c.data_partner, bits, self._n_bits, rows.count()))

    def _outlets(self, kind: int, items: list[str], whole: bool, keys: list[str], name: str) -> DataFrame:
        cells = self._placed.band_bits(self.quantiles, self.cells.labels, "__bit")[whole]
        return outlets_of(self._sets, kind, items, cells, keys, self._n_bits, name)

    @cached_property
    def weekly(self) -> DataFrame:
        date = self.cols.date
        keys = [date, *self.band_keys]
        outlets = self._outlets(DATE_ROWS, [*self._items, date], False, keys, "outlets")
        return weekly_ros(date_rows(self.grain, keys, self.metrics), outlets, keys, self.metrics)

    @cached_property
    def period_ros(self) -> DataFrame:
        return period_ros(self.weekly, self.band_keys, self.metrics)

    @cached_property
    def outlets(self) -> DataFrame:
        return self._outlets(ALL_DATES, self._items, False, self.band_keys, "outlet_count")

    @cached_property
    def totals(self) -> DataFrame:
        return self._outlets(ALL_DATES, self._items, True, self.cell_keys, "total_outlet_count")

    @cached_property
    def shares(self) -> DataFrame:
        return partner_shares(partner_rows(self.grain, self.band_keys, self.cols.data_partner, self.share_metric), self.band_keys)

    @cached_property
    def summary(self) -> DataFrame:
        """One row per band: partner count and the unique top partner."""
        return partner_summary(self.shares, self.band_keys, self.cols.data_partner, self.tie_policy)

    @property
    def dominance(self) -> DataFrame:
        return self.summary.where(F.col("nda_data_partner_with_max_share").isNotNull())

    @property
    def counts(self) -> DataFrame:
        return self.outlets.join(self.summary.select(*self.band_keys, "data_partner_count"), self.band_keys)

    @property
    def _head(self) -> list[str]:
        ros = [f"{m}_ros" for m in self.metrics]
        return [self.cols.period, "product", "product_type", *self.cells.labels, "percentile", "percentile_price", *ros]

    @cached_property
    def joined(self) -> DataFrame:
        result = (
            self.outlets.join(self.period_ros, self.band_keys)
            .join(self.totals, self.cell_keys)
            .join(self.dominance, self.band_keys)
        )
        return self.band_prices.join(result, self.band_keys, "left").select(
            *self._head, "outlet_count", "total_outlet_count", "data_partner_count",
            "nda_data_partner_with_max_share", "nda_max_data_partner_share", CELL_ID,
        )

    @cached_property
    def published(self) -> DataFrame:
        return suppress(self.joined, self.thresholds).select(*self._head, "outlet_count", "total_outlet_count")

    @cached_property
    def outlet_totals(self) -> DataFrame:
        keys = [self.cols.period, "product", "product_type", *self.cells.labels, "total_outlet_count"]
        return self.published.select(*keys).distinct()


def price_bands(
    data: DataFrame,
    period_filter: Sequence[int] | None = None,
    quantiles: Sequence[float] = DEFAULT_QUANTILES,
    metrics: Sequence[str] = DEFAULT_METRICS,
    item_columns: Sequence[str] = ("product",),
    items: Sequence[str] | None = None,
    dims: DimSpec = DimSpec(),
    cols: Columns = Columns(),
    thresholds: Thresholds = Thresholds(),
    tie_policy: str = "drop",
    share_metric: str = "volume",
) -> BandStages:
    """The stages of the job; ``data`` is read several times, so pass a written table when it is expensive."""
    require_columns(data, [cols.date, cols.period, cols.outlet, cols.data_partner, cols.value, cols.quantity, *metrics, *item_columns])
    prices = with_price(data, cols)
    if period_filter is not None:
        prices = prices.where(F.col(cols.period).isin(list(period_filter)))
    prices = expand_items(prices, item_columns, items)
    return BandStages(prices, [float(q) for q in quantiles], list(metrics), dims, cols, thresholds, tie_policy, share_metric)
