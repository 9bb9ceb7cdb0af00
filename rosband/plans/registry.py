"""The registered analyses over the star-schema test tables.

``Study`` wires the library together with the parameters of the test mapping (FIXTURES.md section 3) and
exposes every intermediate by name; each registered query is a property of a fresh ``Study``.  All of them start
from the one extract with its date bound and positivity guards, written once per study (the snapshot step of the
analysed job).  A study owns the intermediates it writes: ``study.datasets.close()`` deletes them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosband.functions.labels import product_label, two_way
from rosband.functions.units import UnitRule
from rosband.operators.bands import edges_long, edges_wide
from rosband.operators.cleaning import continuous_items, outlier_report, remove_outliers, unit_volume
from rosband.operators.disclosure import disclosure_flags
from rosband.operators.joins import Datasets, materialize
from rosband.operators.rollup import CELL_ID
from rosband.plans.avg_price import AvgStages, avg_price
from rosband.plans.job import avg_report, price_report, sales_report
from rosband.plans.price_bands import BandStages, price_bands, with_price
from rosband.plans.report import read_sheet, report_lists
from rosband.schema import DEFAULT_QUANTILES, MULTI_SCHEMA, SALES_SCHEMA, DimSpec, Thresholds
from rosband.sources import retail
from rosband.sources.selection import select_products
from rosband.sources.snapshot import incremental_snapshot, snapshot
from rosband.sources.tables import read_table

# Parameters of the test mapping (fixed; see FIXTURES.md section 3 and README).
PINT_TYPES = ("STANDARD", "PROMO", "MEDIUM", "LARGE")
QUANTITY_TYPES = ("SMALL",)
UNIT_RULES_A = (UnitRule.per(PINT_TYPES, 568), UnitRule.as_quantity(QUANTITY_TYPES))
OUTLIER_GROUPS_A = ("date", "region", "segment", "product")
OUTLIER_METRICS = ("volume", "value")
PRODUCT_SELECTION = ("STANDARD", "PROMO", "MEDIUM", "LARGE", "SMALL")
OUTLIER_GROUPS_B = ("date", "region1", "region2", "region3", "region4", "segment", "product")
EXTRACT_DATE_FROM = "1995-02-01"  # the tables begin in January 1995
FILTER_CATEGORIES = ("BUILDING", "MACHINERY")
FILTER_COUNTRY = "EUROPE"
ITEM_LEVELS = ("product", "product_group")
ITEM_LIST = ("STANDARD", "SMALL", "Pints")
TWICE_CONVERTED = "Draught Any Device pint"
MULTI_REGIONS = ("region1", "region2", "region3", "region4")
CONTINUITY_THRESHOLD = 2
THRESHOLDS = Thresholds(50, 3, 0.5)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns to ``digits`` decimals, for reports and comparison with other engines.

    ``floor(x * 10^d + 0.5) / 10^d`` in plain IEEE arithmetic gives the same bits in every engine, unlike ``round``;
    ``floor`` is written with a remainder because Spark's ends at 2^63.  A first pass at three decimals more folds
    the last-bit noise of sums whose order differs onto one value, so that half-way values round alike.
    """

    def step(c, d):
        scale = float(10**d)
        x = c * F.lit(scale) + F.lit(0.5)
        r = x % F.lit(1.0)
        return (x - r - F.when(r < 0, F.lit(1.0)).otherwise(F.lit(0.0))) / F.lit(scale)

    return df.withColumns({
        f.name: step(step(F.col(f.name), digits + 3), digits) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)
    })


def without_cell_id(df: DataFrame) -> DataFrame:
    return df.drop(CELL_ID)


class Study:
    def __init__(self, spark: SparkSession, sf_dir: str, thresholds: Thresholds = THRESHOLDS):
        self.spark = spark
        self.sf_dir = sf_dir
        self.thresholds = thresholds
        self.datasets = Datasets(spark)

    # -- extracts ------------------------------------------------------------
    @cached_property
    def view(self) -> DataFrame:
        return retail.source_view(self.spark, self.sf_dir)

    @cached_property
    def fact_lazy(self) -> DataFrame:
        """The extract as a plan, for queries that read it once."""
        return retail.sales_extract(self.view, with_calendar=False, date_from=EXTRACT_DATE_FROM)

    @cached_property
    def fact(self) -> DataFrame:
        """The extract written once (the snapshot step), laid out by period so that a
        period filter prunes directories; multi-job plans re-read it."""
        return materialize(self.fact_lazy, partition_by=["period"])

    @cached_property
    def sales_extract(self) -> DataFrame:
        return retail.sales_extract(self.view, date_from=EXTRACT_DATE_FROM)

    @cached_property
    def multi_lazy(self) -> DataFrame:
        return retail.sales_extract_multi(self.view, date_from=EXTRACT_DATE_FROM)

    @cached_property
    def multi(self) -> DataFrame:
        return materialize(self.multi_lazy, partition_by=["period"])

    @cached_property
    def multi_rules(self) -> DataFrame:
        return retail.multi_unit_rules(self.spark, self.sf_dir)

    def multi_selection(self) -> DataFrame:
        """Selection rules derived from ``part``: widget/gear/ring names as draught or
        packaged pints; bolt/rod names as 25 ml measures in any format (upper-cased,
        to exercise the case-insensitive match)."""
        names = read_table(self.spark, self.sf_dir, "part").select("p_name").distinct()
        noun = F.element_at(F.split("p_name", " "), -1)
        pints = names.where(noun.isin("widget", "gear", "ring")).select(
            F.col("p_name").alias("sel_product"),
            F.inline(F.array(
                F.struct(F.lit("pint").alias("sel_size"), F.lit("Draught").alias("sel_format")),
                F.struct(F.lit("pint").alias("sel_size"), F.lit("Packaged").alias("sel_format")),
            )),
        )
        measures = names.where(noun.isin("bolt", "rod")).select(
            F.upper("p_name").alias("sel_product"), F.lit("25ml").alias("sel_size"), F.lit(None).cast("string").alias("sel_format")
        )
        return pints.unionByName(measures)

    # -- cleaning ------------------------------------------------------------
    @cached_property
    def clean(self) -> DataFrame:
        return remove_outliers(self.fact, OUTLIER_GROUPS_A, UNIT_RULES_A, OUTLIER_METRICS, 3)

    @cached_property
    def clean_in_periods(self) -> DataFrame:
        """``clean`` restricted to the band periods, with the filter applied first; written, several jobs read it.

        Outlier groups contain the date, and a date lies in one period, so
        filtering periods before the outlier step gives exactly the rows of
        ``clean`` in those periods -- while the statistics jobs read only the
        selected period directories.
        """
        in_periods = self.fact.where(F.col("period").isin(list(retail.PERIOD_FILTER)))
        return materialize(remove_outliers(in_periods, OUTLIER_GROUPS_A, UNIT_RULES_A, OUTLIER_METRICS, 3))

    @cached_property
    def multi_clean(self) -> DataFrame:
        return remove_outliers(self.multi, OUTLIER_GROUPS_B, self.multi_rules, OUTLIER_METRICS, 3)

    @cached_property
    def multi_clean_in_periods(self) -> DataFrame:
        """``multi_clean`` in the band periods, filtered first (a quarter lies in one period); written."""
        in_periods = self.multi.where(F.col("period").isin(list(retail.PERIOD_FILTER)))
        return materialize(remove_outliers(in_periods, OUTLIER_GROUPS_B, self.multi_rules, OUTLIER_METRICS, 3))

    # -- composites ------------------------------------------------------------
    @cached_property
    def bands(self) -> BandStages:
        return price_bands(self.clean_in_periods, period_filter=retail.PERIOD_FILTER, thresholds=self.thresholds)

    @cached_property
    def bands_nodim(self) -> BandStages:
        return price_bands(
            self.clean_in_periods, period_filter=retail.PERIOD_FILTER, dims=DimSpec(regions=(), segments=()),
            thresholds=self.thresholds,
        )

    @cached_property
    def bands_items(self) -> BandStages:
        """Two item levels and an item list."""
        data = self.clean_in_periods.withColumn("product_group", two_way("product", PINT_TYPES, "Pints", "Others"))
        return price_bands(
            data, period_filter=retail.PERIOD_FILTER, item_columns=ITEM_LEVELS, items=ITEM_LIST, thresholds=self.thresholds
        )

    @cached_property
    def bands_multi(self) -> BandStages:
        return price_bands(
            self.multi_clean_in_periods, period_filter=retail.PERIOD_FILTER, dims=DimSpec.multi(MULTI_REGIONS),
            thresholds=self.thresholds,
        )

    @cached_property
    def avg(self) -> AvgStages:
        return avg_price(self.clean, thresholds=self.thresholds)

    @cached_property
    def avg_multi(self) -> AvgStages:
        return avg_price(self.multi_clean, dims=DimSpec.multi(MULTI_REGIONS), thresholds=self.thresholds)

    # -- the whole job, written and read back ---------------------------------------
    def sheet(self, name: str, variant: str = "A") -> DataFrame:
        """One dataset of the price (or, for ``avg``, the average) report of a variant."""
        root = self.datasets.path("report")
        common = self.job_parameters(variant)
        if name.startswith("avg"):
            avg_report(self.spark, root, **common)
        else:
            price_report(self.spark, root, periods=retail.PERIOD_FILTER, **common)
        return self.spark.read.parquet(f"{root}/{name.removeprefix('avg_')}")

    def shared_sheet(self, name: str, variant: str = "A") -> DataFrame:
        """One committed sheet of the job that makes both reports from the same cleaned rows."""
        root = self.datasets.path("report")
        sales_report(self.spark, root, periods=retail.PERIOD_FILTER, **self.job_parameters(variant))
        return read_sheet(self.spark, root, name)

    def job_parameters(self, variant: str) -> dict:
        multi = variant == "B"
        return {
            "pull": lambda _spark: self.multi_lazy if multi else self.fact_lazy,
            "groups": OUTLIER_GROUPS_B if multi else OUTLIER_GROUPS_A,
            "rules": self.multi_rules if multi else UNIT_RULES_A,
            "dims": DimSpec.multi(MULTI_REGIONS) if multi else DimSpec(),
            "thresholds": self.thresholds,
            "schema": MULTI_SCHEMA if multi else SALES_SCHEMA,
        }


def owned(name: str, spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Datasets]:
    """A registered query with the handle that deletes its intermediates once the result is consumed."""
    study = Study(spark, sf_dir)
    with study.datasets.active():
        return round_doubles(without_cell_id(_BUILD[name](study))), study.datasets


def _region_dims(s: Study) -> DataFrame:
    c = read_table(s.spark, s.sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(s.spark, s.sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(s.spark, s.sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    j = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
    return j.select("c_custkey", *[e.alias(k) for k, e in retail.region_columns().items()])


def _part_items(s: Study) -> DataFrame:
    return read_table(s.spark, s.sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size").withColumns(retail.item_columns())


def _product_label(s: Study) -> DataFrame:
    p = _part_items(s)
    return p.select("p_partkey", product_label("item", "size", "format", retail.LABELLED_FORMATS).alias("product"))


def _snapshot_roundtrip(s: Study) -> DataFrame:
    path = s.datasets.path("snapshot")
    calls = []

    def compute(_spark):
        calls.append(1)
        return s.fact_lazy

    snapshot(s.spark, path, compute, partition_by=["period"])
    again = snapshot(s.spark, path, compute, partition_by=["period"])
    if len(calls) != 1:
        raise AssertionError("snapshot recomputed although complete")
    return again.select(*s.fact_lazy.columns)


def _snapshot_incremental(s: Study) -> DataFrame:
    """All periods pulled, then one of them again under a new version."""
    path = s.datasets.path("snapshot")
    pulled = []

    def compute(_spark, periods):
        pulled.append(sorted(periods))
        return s.fact_lazy.where(F.col("period").isin(periods))

    versions = {r["period"]: 1 for r in s.fact_lazy.select("period").distinct().collect()}
    incremental_snapshot(s.spark, path, compute, versions)
    if not versions:
        return s.fact_lazy
    last = max(versions)
    again = incremental_snapshot(s.spark, path, compute, {**versions, last: 2})
    if pulled != [sorted(versions), [last]]:
        raise AssertionError("periods pulled although complete")
    return again.select(*s.fact_lazy.columns)


def _unit_volume_multi(s: Study) -> DataFrame:
    """All serving sizes, and one product with two rules (divided twice)."""
    rules = s.multi_rules.withColumn("step", F.lit(1))
    twice = rules.where(F.col("product") == TWICE_CONVERTED).select("product", F.lit(25.0).alias("divisor"), F.lit(2).alias("step"))
    return unit_volume(s.multi_lazy, rules.unionByName(twice))


def _product_selection_multi(s: Study) -> DataFrame:
    return retail.sales_extract_multi(s.view, selection=s.multi_selection(), date_from=EXTRACT_DATE_FROM)


def _suppression(s: Study) -> DataFrame:
    return disclosure_flags(s.avg.joined, s.thresholds)


_BUILD = {
    "sales_extract": lambda s: s.sales_extract,
    "sales_extract_multi": lambda s: s.multi_lazy,
    "sales_extract_filtered": lambda s: retail.sales_extract(
        s.view, date_from=EXTRACT_DATE_FROM, categories=FILTER_CATEGORIES, country=FILTER_COUNTRY, with_calendar=False
    ),
    "sales_extract_multi_filtered": lambda s: retail.sales_extract_multi(
        s.view, date_from=EXTRACT_DATE_FROM, categories=FILTER_CATEGORIES[:1], country=FILTER_COUNTRY
    ),
    "product_selection": lambda s: select_products(s.fact_lazy, PRODUCT_SELECTION),
    "product_selection_multi": _product_selection_multi,
    "region_dims": _region_dims,
    "product_rollup": lambda s: _part_items(s).select("p_partkey", "p_name", F.col("item").alias("product")),
    "product_label": _product_label,
    "snapshot_roundtrip": _snapshot_roundtrip,
    "snapshot_incremental": _snapshot_incremental,
    "unit_volume": lambda s: unit_volume(s.fact_lazy, UNIT_RULES_A),
    "unit_volume_multi": _unit_volume_multi,
    "unit_price": lambda s: with_price(s.fact_lazy),
    "remove_outliers": lambda s: s.clean,
    "outlier_report": lambda s: outlier_report(unit_volume(s.fact, UNIT_RULES_A), s.clean, ("product",)),
    "continuous_items": lambda s: continuous_items(s.fact, CONTINUITY_THRESHOLD, item_column="product"),
    "label_expand": lambda s: s.bands.labelled,
    "price_quantile_cube": lambda s: edges_wide(s.bands.edges, s.bands.date_keys, DEFAULT_QUANTILES),
    "price_quantile_nodim": lambda s: edges_wide(s.bands_nodim.edges, s.bands_nodim.date_keys, DEFAULT_QUANTILES),
    "band_edges": lambda s: edges_long(s.bands.edges, s.bands.date_keys, DEFAULT_QUANTILES),
    "band_assign": lambda s: s.bands.banded,
    "band_prices": lambda s: s.bands.band_prices,
    "outlet_count_cube": lambda s: s.bands.totals,
    "weekly_ros": lambda s: s.bands.weekly,
    "period_ros": lambda s: s.bands.period_ros,
    "band_counts": lambda s: s.bands.counts,
    "partner_share": lambda s: s.bands.shares,
    "partner_dominance": lambda s: s.bands.dominance,
    "band_prices_left": lambda s: s.bands.joined,
    "price_bands": lambda s: s.bands.published,
    "outlet_totals": lambda s: s.bands.outlet_totals,
    "price_bands_items": lambda s: s.bands_items.published,
    "price_bands_multi": lambda s: s.bands_multi.published,
    "outlet_totals_multi": lambda s: s.bands_multi.outlet_totals,
    "avg_price_cube": lambda s: s.avg.cube,
    "partner_share_daily": lambda s: s.avg.shares,
    "suppression": _suppression,
    "avg_price": lambda s: s.avg.published,
    "avg_price_multi": lambda s: s.avg_multi.published,
    "report_lists_prices": lambda s: report_lists(s.bands.published, ["region", "segment", "product"]),
    "report_lists_avg": lambda s: report_lists(s.avg.published, ["region", "segment", "product", "date"]),
    "job_prices": lambda s: s.sheet("PC_Data"),
    "job_outlet_totals": lambda s: s.sheet("OT_Data"),
    "job_lists": lambda s: s.sheet("lists"),
    "job_edges": lambda s: s.sheet("edges"),
    "job_banded": lambda s: s.sheet("banded"),
    "job_totals": lambda s: s.sheet("totals"),
    "job_prices_multi": lambda s: s.sheet("PC_Data", "B"),
    "job_avg": lambda s: s.sheet("avg"),
    "job_avg_lists": lambda s: s.sheet("avg_lists"),
    "job_avg_multi": lambda s: s.sheet("avg", "B"),
    "job_shared_prices": lambda s: s.shared_sheet("PC_Data"),
    "job_shared_avg": lambda s: s.shared_sheet("avg"),
    "job_shared_removed": lambda s: s.shared_sheet("removed"),
    "job_shared_removed_multi": lambda s: s.shared_sheet("removed", "B"),
}


def _query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return owned(name, spark, sf_dir)[0]

    run.__name__ = name
    return run


QUERIES = {name: _query(name) for name in _BUILD}
