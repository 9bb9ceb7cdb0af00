"""The point-of-sale extract over any sales view, and the star-schema view of the test tables.

The analysed job pulls ``SUM`` of value, volume and quantity per (date, outlet, product, dimensions,
data partner) from a database view, filtered by date, category, products, country and positivity.
``ViewSpec`` says which columns (or SQL expressions) of a view play these parts; ``extract`` filters and
aggregates any view, be it a table, a JDBC frame (``sources.jdbc``) or the test join built here:

======================  ===================================================
date                    first day of the month (A) or quarter (B) of ``l_shipdate``
period / qtr / year     ``year`` / ``quarter`` / ``year`` of ``l_shipdate``
outlet                  ``o_custkey``
product                 ``p_type`` (variant A) or a rolled-up label (B)
region                  ``r_name`` (A) / four membership columns (B)
segment                 ``Core`` for AUTOMOBILE and BUILDING, else ``Other``
data_partner            ``l_suppkey % 10`` as a string
value, quantity         ``sum(l_extendedprice)``, ``sum(l_quantity)``
volume                  ``sum(l_quantity * 568)`` (millilitres)
======================  ===================================================

``c_mktsegment`` is a grouping key that is not selected, like the unselected quality tier of the source
job: rows are not re-aggregated over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosband.functions.labels import first_match, keyword_rollup, membership, product_label, two_way
from rosband.schema import PINT_ML
from rosband.sources.selection import select_products_multi
from rosband.sources.tables import read_table

# Fixed values of the test mapping (FIXTURES.md section 3).
CORE_SEGMENTS = ("AUTOMOBILE", "BUILDING")
SEGMENT_IN, SEGMENT_OUT = "Core", "Other"
ROLLUP_RULES = (
    ("widget", "Any Device"), ("gear", "Any Device"), ("gizmo", "Any Device"), ("anvil", "Any Device"),
    ("ring", "Any Fitting"), ("bolt", "Any Fitting"), ("rod", "Any Fitting"), ("plate", "Any Fitting"),
)
LABELLED_FORMATS = ("Draught", "Packaged")
PERIOD_FILTER = (1995, 1999)


def source_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level sales with every attribute an extract may select or filter on.

    nation (25 rows) and region (5 rows) are fixed-size dimension tables and are
    broadcast; the other joins are left to the planner (sort-merge or
    shuffled hash join on the join keys, with AQE).  Customers are joined to
    orders first, so a sale moves by order and by part and not by customer too.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).drop("n_regionkey", "r_regionkey")
    orders = (
        o.join(c, F.col("o_custkey") == c.c_custkey)
        .join(F.broadcast(geo), F.col("c_nationkey") == geo.n_nationkey)
        .drop("c_custkey", "c_nationkey")
    )
    return li.join(orders, li.l_orderkey == orders.o_orderkey).join(p, li.l_partkey == p.p_partkey).drop("o_orderkey")


@dataclass(frozen=True)
class ViewSpec:
    """The parts that a sales view's columns play; every field is a column name or SQL expression."""

    date: str = "l_shipdate"
    outlet: str = "o_custkey"
    product_id: str = "l_partkey"
    product: str = "p_type"
    category: str = "c_mktsegment"
    country: str = "r_name"
    data_partner: str = "cast(l_suppkey % 10 as string)"
    value: str = "l_extendedprice"
    quantity: str = "l_quantity"
    volume: str = f"l_quantity * {PINT_ML}D"
    hidden: tuple[str, ...] = ("c_mktsegment",)  # grouping keys that are not selected


STAR = ViewSpec()


def filtered(
    view: DataFrame,
    spec: ViewSpec = STAR,
    date_from: str | None = None,
    categories: Sequence[str] | None = None,
    products: Sequence[str] | None = None,
    country: str | None = None,
    guards: bool = True,
) -> DataFrame:
    """The rows of a sales view that an extract takes; all filters are plain predicates that reach the scan.

    ``date_from`` is a lower bound on the sale date, ``categories`` an IN-list (or one value) on the outlet category,
    ``products`` an IN-list, ``country`` an equality; ``guards`` keeps rows whose ids and measures are positive.
    """
    v = view
    if date_from is not None:
        dtype = v.select(F.expr(spec.date)).schema[0].dataType.simpleString()
        v = v.where(F.expr(spec.date) >= F.lit(date_from).cast(dtype))
    if categories is not None:
        v = v.where(F.expr(spec.category).isin(list(categories)))
    if products is not None:
        v = v.where(F.expr(spec.product).isin(list(products)))
    if country is not None:
        v = v.where(F.expr(spec.country) == country)
    if guards:
        for part in (spec.outlet, spec.product_id, spec.volume, spec.value, spec.quantity):
            v = v.where(F.expr(part) > 0)
    return v


def extract(
    view: DataFrame, keys: Mapping[str, F.Column], spec: ViewSpec = STAR, derived: Mapping[str, F.Column] | None = None
) -> DataFrame:
    """Measure sums per ``keys`` (output names) and the view's hidden keys, which are dropped afterwards.

    ``derived`` are keys that other keys (or hidden ones, ``__hidden<i>``) decide: expressions over these, made from the
    aggregated rows, which are so not moved and compared by them.
    """
    hidden = {f"__hidden{i}": F.expr(h) for i, h in enumerate(spec.hidden)}
    derived = derived or {}
    order = [*keys, "value", "quantity", "volume"]
    keys = {n: e for n, e in keys.items() if n not in derived}
    sums = [F.sum(F.expr(e)).alias(n) for n, e in (("value", spec.value), ("quantity", spec.quantity), ("volume", spec.volume))]
    out = view.groupBy(*[e.alias(n) for n, e in {**keys, **hidden}.items()]).agg(*sums)
    return out.withColumns(dict(derived)).select(*order) if derived else out.select(*order)


def _calendar(spec: ViewSpec, grain: str) -> dict[str, F.Column]:
    d = F.expr(spec.date).cast("date")
    return {
        "date": F.trunc(d, grain),
        "period": F.year(d).cast("int"),
        "qtr": F.quarter(d).cast("int"),
        "year": F.year(d).cast("int"),
    }


def _derived(names: Mapping[str, F.Column], spec: ViewSpec) -> dict[str, F.Column]:
    """The keys of an extract that its date (the first day of a month or quarter) and its hidden category decide."""
    parts = {"period": F.year("date").cast("int"), "qtr": F.quarter("date").cast("int"), "year": F.year("date").cast("int")}
    if spec.category in spec.hidden:
        parts["segment"] = segment_expr(f"__hidden{spec.hidden.index(spec.category)}")
    return {n: e for n, e in parts.items() if n in names}


def segment_expr(category: str = "c_mktsegment") -> F.Column:
    return two_way(F.expr(category), CORE_SEGMENTS, SEGMENT_IN, SEGMENT_OUT)


def sales_extract(
    view: DataFrame, spec: ViewSpec = STAR, region: str = "r_name", with_calendar: bool = True, **filters
) -> DataFrame:
    """Variant A extract: one region column, one two-way segment column.  ``filters`` are those of ``filtered``."""
    t = _calendar(spec, "month")
    if not with_calendar:
        t = {k: t[k] for k in ("date", "period")}
    keys = {
        **t,
        "outlet": F.expr(spec.outlet).cast("long"),
        "product": F.expr(spec.product),
        "region": F.expr(region),
        "segment": segment_expr(spec.category),
        "data_partner": F.expr(spec.data_partner),
    }
    return extract(filtered(view, spec, **filters), keys, spec, _derived(keys, spec))


# ----------------------------------------------------------------------------
# Variant B: four overlapping region membership columns, product roll-up and label
# ----------------------------------------------------------------------------

def region_columns() -> dict:
    """region1..region4 labels; ``'n'`` = not a member of that region dimension."""
    nk = F.col("n_nationkey")
    zones = {
        "Zone A": [k for k in range(25) if k % 3 == 0],
        "Zone B": [k for k in range(25) if k % 3 == 1],
    }
    return {
        "region1": two_way("r_name", ["EUROPE"], "Europe", "n"),
        "region2": F.when(nk < 5, F.lit("Core Nations")).otherwise(F.lit("n")),
        "region3": first_match(
            [(F.col("n_name") == "NATION_1", "Nation 1"), (F.col("n_name") == "NATION_2", "Nation 2")], "n"
        ),
        "region4": membership(nk, zones, "n"),
    }


def item_columns() -> dict:
    """size, format and the rolled-up product name."""
    return {
        "size": F.when(F.col("p_size") <= 25, F.lit("25ml")).otherwise(F.lit("pint")),
        "format": first_match([(F.col("p_type") == "STANDARD", "Draught"), (F.col("p_type") == "PROMO", "Packaged")], "Other"),
        "item": keyword_rollup("p_name", ROLLUP_RULES),
    }


def sales_extract_multi(
    view: DataFrame, selection: DataFrame | None = None, spec: ViewSpec = STAR, **filters
) -> DataFrame:
    """Variant B extract: region1..region4, segment, labelled product; dates are quarters.

    ``selection`` (optional) is a multi-attribute selection table applied with ``select_products_multi`` before
    aggregation; ``filters`` are those of ``filtered``.
    """
    v = filtered(view, spec, **filters).withColumns({k: e for k, e in item_columns().items() if k != "item"})
    if selection is not None:
        v = select_products_multi(v, selection, product="p_name")
    t = _calendar(spec, "quarter")
    keys = {
        "date": t["date"],
        "period": t["period"],
        "outlet": F.expr(spec.outlet).cast("long"),
        **{c: F.col(c) for c in ("p_name", "size", "format")},
        **region_columns(),
        "segment": segment_expr(spec.category),
        "__nation": F.col("n_nationkey"),
        "data_partner": F.expr(spec.data_partner),
    }
    out = extract(v, keys, spec, _derived(keys, spec))
    # roll-up after the aggregation: rolled-up names are not re-aggregated
    rolled = keyword_rollup("p_name", ROLLUP_RULES)
    out = out.withColumn("product", product_label(rolled, "size", "format", LABELLED_FORMATS))
    return out.drop("p_name", "size", "format", "__nation")


def multi_unit_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit rule table for the labelled products, derived from ``part``: millilitres of a serving by format and size."""
    part = read_table(spark, sf_dir, "part").select("p_name", "p_type", "p_size").withColumns(item_columns())
    small, draught, packaged = F.col("size") == "25ml", F.col("format") == "Draught", F.col("format") == "Packaged"
    divisor = (
        F.when(small & packaged, F.lit(200.0))
        .when(small, F.lit(25.0))
        .when(draught, F.lit(PINT_ML))
        .when(packaged, F.lit(330.0))
        .otherwise(F.lit(500.0))
    )
    label = product_label("item", "size", "format", LABELLED_FORMATS).alias("product")
    return part.select(label, divisor.alias("divisor")).distinct()
