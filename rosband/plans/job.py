"""The whole job: extract (or its snapshot) to written report sheets and datasets.

Each function takes the extract as a callable, keeps its snapshot, casts it to the declared types, cleans it and
writes one dataset per sheet under ``root``:

* ``price_report``: ``PC_Data`` (published bands), ``OT_Data`` (outlet totals), ``lists``, and the datasets
  ``edges``, ``banded`` and ``totals``;
* ``avg_report``: ``avg`` (published averages) and ``lists``;
* ``sales_report``: the sheets of both from one pull and one cleaning, and ``removed`` (rows in and removed per metric),
  committed as one version (``ReportRun``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rosband.functions.units import UnitRule
from rosband.operators.bands import edges_wide
from rosband.operators.cleaning import remove_outliers, remove_outliers_counted
from rosband.operators.joins import materialize
from rosband.operators.rollup import CELL_ID
from rosband.plans.avg_price import AvgStages, avg_price
from rosband.plans.price_bands import BandStages, price_bands
from rosband.plans.report import ReportRun, report_lists, write_report
from rosband.schema import SALES_SCHEMA, DimSpec, Thresholds, conform
from rosband.sources.snapshot import snapshot


def _cleaned(
    spark: SparkSession,
    root: str,
    pull: Callable[[SparkSession], DataFrame],
    groups: Sequence[str],
    rules: Sequence[UnitRule] | DataFrame,
    metrics: Sequence[str],
    schema: T.StructType,
    periods: Sequence[int] | None,
) -> DataFrame:
    extract = snapshot(spark, f"{root.rstrip('/')}/extract", pull, partition_by=["period"])
    data = conform(extract, schema)
    if periods is not None:  # outlier groups hold the date, and a date is in one period
        data = data.where(data["period"].isin(list(periods)))
    return materialize(remove_outliers(data, groups, rules, metrics, 3))


def price_report(
    spark: SparkSession,
    root: str,
    pull: Callable[[SparkSession], DataFrame],
    groups: Sequence[str],
    rules: Sequence[UnitRule] | DataFrame,
    periods: Sequence[int],
    dims: DimSpec = DimSpec(),
    thresholds: Thresholds = Thresholds(),
    metrics: Sequence[str] = ("volume", "value"),
    schema: T.StructType = SALES_SCHEMA,
    fmt: str = "parquet",
) -> BandStages:
    clean = _cleaned(spark, root, pull, groups, rules, metrics, schema, periods)
    stages = price_bands(clean, period_filter=periods, dims=dims, thresholds=thresholds)
    write = partial(write_report, root=root, fmt=fmt)
    write({
        "edges": edges_wide(stages.edges, stages.date_keys, stages.quantiles).drop(CELL_ID),
        "banded": stages.banded.drop(CELL_ID),
        "totals": stages.totals.drop(CELL_ID),
        "PC_Data": stages.published,
    })
    published = spark.read.schema(stages.published.schema).format(fmt).options(header="true").load(f"{root.rstrip('/')}/PC_Data")
    keys = [c for c in stages.outlet_totals.columns]
    write({"OT_Data": published.select(*keys).distinct(), "lists": report_lists(published, ["region", "segment", "product"])})
    return stages


def avg_report(
    spark: SparkSession,
    root: str,
    pull: Callable[[SparkSession], DataFrame],
    groups: Sequence[str],
    rules: Sequence[UnitRule] | DataFrame,
    dims: DimSpec = DimSpec(),
    thresholds: Thresholds = Thresholds(),
    metrics: Sequence[str] = ("volume", "value"),
    schema: T.StructType = SALES_SCHEMA,
    fmt: str = "parquet",
) -> AvgStages:
    clean = _cleaned(spark, root, pull, groups, rules, metrics, schema, None)
    stages = avg_price(clean, dims=dims, thresholds=thresholds)
    write_report({"avg": stages.published}, root, fmt)
    published = spark.read.schema(stages.published.schema).format(fmt).options(header="true").load(f"{root.rstrip('/')}/avg")
    write_report({"lists": report_lists(published, ["region", "segment", "product", "date"])}, root, fmt)
    return stages


def sales_report(
    spark: SparkSession,
    root: str,
    pull: Callable[[SparkSession], DataFrame],
    groups: Sequence[str],
    rules: Sequence[UnitRule] | DataFrame,
    periods: Sequence[int],
    dims: DimSpec = DimSpec(),
    thresholds: Thresholds = Thresholds(),
    metrics: Sequence[str] = ("volume", "value"),
    schema: T.StructType = SALES_SCHEMA,
    fmt: str = "parquet",
) -> ReportRun:
    """Price bands and average prices of one cleaned extract; read the sheets with ``read_sheet``.

    The rows are cleaned over all periods and written once, laid out by period.  ``groups`` must hold the date: a date lies
    in one period, so the bands of ``periods`` are those of rows cleaned in these periods alone.
    """
    if "date" not in groups:
        raise ValueError("bands of some periods can share cleaned rows only if the outlier groups hold the date")
    extract = snapshot(spark, f"{root.rstrip('/')}/extract", pull, partition_by=["period"])
    clean, removed = remove_outliers_counted(conform(extract, schema), groups, rules, metrics, 3, partition_by=["period"])
    bands = price_bands(clean, period_filter=periods, dims=dims, thresholds=thresholds)
    averages = avg_price(clean, dims=dims, thresholds=thresholds)
    with ReportRun(spark, root, fmt) as run:
        run.write({
            "removed": removed,
            "edges": edges_wide(bands.edges, bands.date_keys, bands.quantiles).drop(CELL_ID),
            "banded": bands.banded.drop(CELL_ID),
            "totals": bands.totals.drop(CELL_ID),
            "PC_Data": bands.published,
            "avg": averages.published,
        })
        prices, avg = run.read("PC_Data"), run.read("avg")
        run.write({
            "OT_Data": prices.select(*bands.outlet_totals.columns).distinct(),
            "lists": report_lists(prices, ["region", "segment", "product"]),
            "avg_lists": report_lists(avg, ["region", "segment", "product", "date"]),
        })
    return run
