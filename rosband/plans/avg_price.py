"""Average price and rate of sale per date, item and cell, with disclosure control.

No period filter: every date is used.  Per date x item x cell: metric sums,
distinct outlets, the unweighted mean of row prices (not sum(value) /
sum(quantity)), distinct data partners; ROS = sum / outlets; data-partner
shares of volume per date and cell with the unique largest partner.

No row is expanded: the rows are aggregated per finest cell and partner, from which the cells are rolled up, and per outlet
into the set of cells it is in.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosband.functions.measures import rate_of_sale
from rosband.operators.disclosure import partner_shares, partner_summary, suppress
from rosband.operators.joins import materialize
from rosband.operators.rollup import CELL_ID, roll_up
from rosband.operators.ros import outlets_per_cell
from rosband.plans.price_bands import with_price
from rosband.schema import DEFAULT_METRICS, Columns, DimSpec, Thresholds, require_columns


@dataclass
class AvgStages:
    keys: list[str]
    cube: DataFrame
    shares: DataFrame
    dominance: DataFrame
    joined: DataFrame
    published: DataFrame


def avg_price(
    data: DataFrame,
    metrics: Sequence[str] = DEFAULT_METRICS,
    dims: DimSpec = DimSpec(),
    cols: Columns = Columns(),
    thresholds: Thresholds = Thresholds(),
    tie_policy: str = "drop",
    share_metric: str = "volume",
) -> AvgStages:
    metrics = list(metrics)
    require_columns(data, [cols.date, cols.outlet, cols.data_partner, cols.value, cols.quantity, cols.product, *metrics])
    prices = with_price(data, cols)
    measures = list(dict.fromkeys([*metrics, share_metric]))
    members = [c for c in dict.fromkeys([*dims.regions, *dims.segments]) if c in prices.columns]
    rows = prices.where(F.col(cols.outlet).isNotNull() & F.col(cols.data_partner).isNotNull())
    item = [cols.date, cols.product]
    # sums per finest cell and partner; the mean row price is carried as (sum, count) so it stays row-weighted
    sums = [*measures, "__price_sum", "__price_n"]
    finest = rows.groupBy(*item, *members, cols.data_partner).agg(
        *[F.sum(m).alias(m) for m in measures],
        F.sum(cols.price).alias("__price_sum"),
        F.count(cols.price).alias("__price_n"),
        F.count(F.lit(1)).alias("__rows"),
    )
    # one more exchange of these, by keys that every cell of a partner keeps
    finest = finest.repartition(*item, cols.data_partner)
    rolled = roll_up(finest, [*item, cols.data_partner], dims, dict.fromkeys([*sums, "__rows"], F.sum))
    keys = [*item, *rolled.keys]
    partners = materialize(rolled.df)
    # the rows move once, by outlet, which is in a set of cells; how many are in the same cells is taken apart into cells
    pairs = partners.agg(F.sum("__rows")).first()[0] or 0
    outlets = outlets_per_cell(rows, item, cols.outlet, dims, partners.select(*rolled.keys).distinct(), pairs).select(*keys, "outlet_count")
    volumes = partners.drop("__rows").withColumn("dp_volume", F.col(share_metric))
    every = partner_shares(volumes, keys, sums)  # one window pass gives the shares and the sums of a cell
    shares = every.drop(*sums)
    summary = partner_summary(every, keys, cols.data_partner, tie_policy, sums)
    has_top = F.col("nda_data_partner_with_max_share").isNotNull()
    cube = summary.withColumns({f"sum_{m}": F.col(m) for m in metrics})
    cube = cube.withColumn("avg_price", F.try_divide("__price_sum", F.col("__price_n").cast("double"))).drop(*sums)
    cube = outlets.join(cube, keys)
    cube = cube.withColumns({f"{m}_ros": rate_of_sale(f"sum_{m}", "outlet_count") for m in metrics})
    dom = summary.where(has_top).drop(*sums)

    labels = list(rolled.labels)
    ros_cols = [f"{m}_ros" for m in metrics]
    head = [cols.date, cols.product, *labels, "avg_price", *ros_cols, "outlet_count"]
    full, cube = cube, cube.drop("nda_data_partner_with_max_share", "nda_max_data_partner_share")
    joined = full.where(has_top).select(
        *head, "data_partner_count", "nda_data_partner_with_max_share", "nda_max_data_partner_share", CELL_ID
    )
    published = suppress(joined, thresholds).select(*head)
    return AvgStages(keys=keys, cube=cube, shares=shares, dominance=dom, joined=joined, published=published)
