"""Invariants of the published outputs and checks on the physical plans."""

import os
import re

import pytest
from pyspark.sql import functions as F

from rosband.plans.registry import Study

SF = os.environ.get("ROSBAND_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def study(spark):
    from rosband.schema import Thresholds

    return Study(spark, SF, thresholds=Thresholds(5, 3, 0.5))


def test_shares_sum_to_one(study):
    keys = study.bands.band_keys
    s = study.bands.shares.groupBy(*keys).agg(F.sum("dp_volume_share").alias("t"))
    assert s.where(F.abs(F.col("t") - 1.0) > 1e-9).count() == 0


def test_published_meets_thresholds_and_counts(study):
    j = study.bands.joined.where(F.col("outlet_count").isNotNull())
    assert j.where(F.col("outlet_count") > F.col("total_outlet_count")).count() == 0
    pub = study.bands.published
    assert pub.count() > 0
    assert pub.where(F.col("outlet_count") < 5).count() == 0


def test_top_edge_is_max_price(study):
    st = study.bands
    mx = st.labelled.groupBy(*st.date_keys).agg(F.max("price").alias("mx"))
    e = st.edges.select(*st.date_keys, F.element_at("edges", -1).alias("top"))
    bad = mx.join(e, st.date_keys).where(F.col("mx") != F.col("top"))
    assert bad.count() == 0


def test_filters_reach_the_scan(spark):
    from rosband.sources import retail

    v = retail.source_view(spark, SF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = retail.sales_extract(v, date_from="1996-01-01")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # guards reach the scans (and are propagated across the join keys)
    assert "GreaterThan(o_custkey,0)" in plan and "GreaterThan(p_partkey,0)" in plan and "GreaterThan(c_custkey,0)" in plan
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01" in plan
    # column pruning: unused lineitem columns are not read
    assert "l_discount" not in plan and "l_comment" not in plan


def test_the_date_bound_removes_rows(study):
    from rosband.sources import retail

    everything = retail.sales_extract(study.view, with_calendar=False, guards=False)
    assert 0 < study.fact.count() < everything.count()
    assert study.fact.agg(F.min("date")).first()[0].isoformat() == "1995-02-01"


def test_stages_write_only_what_they_need(spark):
    own = Study(spark, SF)
    with own.datasets.active():
        assert own.fact.count() > 0
        before = len(own.datasets.paths)
        own.clean_in_periods  # noqa: B018  statistics of two metrics, and the cleaned rows
        cleaned = len(own.datasets.paths)
        own.bands.labelled.count()
    assert cleaned == before + 3 and len(own.datasets.paths) == cleaned  # no edges, no grain
    own.datasets.close()


def test_avg_price_never_expands_rows(study, spark):
    """Every expansion stands above an aggregate of the rows: cells are rolled up, parents from children."""
    import importlib

    plan_module = importlib.import_module("rosband.plans.avg_price")
    seen = []
    real = plan_module.materialize
    plan_module.materialize = lambda df: seen.append(df) or real(df)
    try:
        stages = plan_module.avg_price(study.clean)
    finally:
        plan_module.materialize = real
    for df in (*seen, stages.published):
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        below = [i for i, line in enumerate(plan) if "Generate" in line]
        assert below
        for i in below:  # its input is an aggregate, a pruning projection of one at most
            assert any("Aggregate" in line for line in plan[i + 1 : i + 3]), plan[i : i + 3]


def test_rows_are_joined_with_edges_before_they_are_expanded(study):
    plan = study.bands.banded._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction(array_contains" not in plan  # edges are looked up by place, not searched
    assert plan.count("Generate ") == 1 and plan.count("Join ") >= 1
    generate, joins = plan.index("Generate "), [m.start() for m in re.finditer("Join ", plan)]
    assert all(generate < j for j in joins)  # the expansion stands above every join of the rows


def test_edges_hold_no_state_over_the_prices_of_a_cell(spark):
    from rosband.operators.bands import edges_from_histogram, price_histogram
    from rosband.schema import DEFAULT_QUANTILES

    df = spark.range(1000).selectExpr("id % 3 AS k", "cast(id % 97 AS double) AS price")
    hist = price_histogram(df, ["k"])
    plan = edges_from_histogram(hist, ["k"], DEFAULT_QUANTILES)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("price" in k for k in keys)  # counted by price
    assert any("bucket" in k for k in keys)  # ordered within one bucket of a cell
    assert "percentile" not in plan


def test_price_buckets_follow_the_price(spark):
    from rosband.operators.bands import price_bucket

    prices = [-1e300, -7.5, -7.4, -1e-300, -0.0, 0.0, 5e-324, 1e-300, 0.1, 0.1000001, 1.0, 1.5, 2.0, 1e9, 1e300, 1.7e308]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prices)], "i int, price double")
    got = [r["b"] for r in df.orderBy("i").select(price_bucket(F.col("price")).alias("b")).collect()]
    assert got == sorted(got)


def test_edges_of_many_cells_are_found_by_place(spark):
    """100 regions x 100 segments on a date: every row meets its own cells' edges."""
    from rosband.operators.bands import assign_bands
    from rosband.operators.rollup import CELL_ID
    from rosband.schema import DimSpec

    cell = lambda i: (f"r{i // 100:02d}", f"s{i % 100:02d}")
    edges = [(1, 0, *cell(i), [float(i)]) for i in range(10_000) if i % 7] + [(1, 3, "GB", "All Pubs", [2e4])]
    e = spark.createDataFrame(edges, f"d int, {CELL_ID} int, region string, segment string, edges array<double>")
    rows = spark.createDataFrame([(1, i, *cell(i), i + j * 0.5) for i in range(0, 10_000, 37) for j in (0, 1)], "d int, i int, region string, segment string, price double")
    got = assign_bands(rows, DimSpec(), e, ["d"], ["d", "i", "price"], [1.0])
    want = {(i, i + j * 0.5, 0, *cell(i), 1.0 if j == 0 else None) for i in range(0, 10_000, 37) if i % 7 for j in (0, 1)}
    want |= {(i, i + j * 0.5, 3, "GB", "All Pubs", 1.0) for i in range(0, 10_000, 37) for j in (0, 1)}
    assert {tuple(r) for r in got.select("i", "price", CELL_ID, "region", "segment", "percentile").collect()} == want


def test_sets_of_numbers_are_exact_beyond_one_word_and_merge(spark):
    from rosband.operators.numbers import set_words
    from rosband.operators.ros import distinct_outlets, merged_sets

    ids = [0, 63, 64, 65, 4095, 40_000, 2**62, -1, -64, -(2**63), 2**63 - 1]
    rows = [(k, d, i) for k in ("a", "b") for d in (1, 2) for n, i in enumerate(ids * 2) if (n + d) % 3 and (k == "a" or i > 60)]
    for kind, make in (("long", lambda i: i), ("string", lambda i: f"outlet {i}")):
        df = spark.createDataFrame([(k, d, make(i)) for k, d, i in rows], f"k string, d int, o {kind}")
        sets = merged_sets(set_words(df, "o"), ["k", "d"])
        got = {(r["k"], r["d"]): r["outlet_count"] for r in distinct_outlets(sets, ["k", "d"]).collect()}
        assert got == {(k, d): len({i for kk, dd, i in rows if (kk, dd) == (k, d)}) for k, d, _ in rows}
        over = {r["k"]: r["outlet_count"] for r in distinct_outlets(merged_sets(sets, ["k"]), ["k"]).collect()}
        assert over == {k: len({i for kk, _, i in rows if kk == k}) for k, _, _ in rows}


@pytest.mark.parametrize("repeated", [True, False])
def test_counting_prices_first_is_a_choice_of_plan_only(spark, repeated):
    import numpy as np

    from rosband.operators.bands import counted_prices, edges_from_histogram
    from rosband.schema import DEFAULT_QUANTILES

    prices = [float(i % (13 if repeated else 10_007)) * 1.25 for i in range(3_000)]
    df = spark.createDataFrame([(i % 2, p) for i, p in enumerate(prices)], "k int, price double")
    counted = counted_prices(df, ["k"])
    assert (counted.count() < 100) == repeated
    for r in edges_from_histogram(counted, ["k"], DEFAULT_QUANTILES).collect():
        own = [p for i, p in enumerate(prices) if i % 2 == r["k"]]
        assert np.allclose(r["edges"], np.percentile(own, [20, 40, 60, 80, 100]), rtol=0, atol=1e-9)


@pytest.mark.parametrize("n_regions, n_segments", [(3, 2), (30, 25)])  # one word of cells, and several pieces
def test_outlets_per_cell_like_brute_force(spark, monkeypatch, n_regions, n_segments):
    """An outlet with rows in several regions and segments counts once in every cell; tasks follow the rows."""
    import random

    from rosband.operators import numbers, ros
    from rosband.operators.rollup import CELL_ID
    from rosband.schema import DimSpec

    monkeypatch.setattr(numbers, "ROWS_PER_TASK", 20)
    rng = random.Random(n_regions)
    rows = [
        (rng.choice("de"), f"o{rng.randint(0, 60)}", f"r{rng.randrange(n_regions)}", rng.choice([None, *(f"s{i}" for i in range(n_segments))]))
        for _ in range(900)
    ]
    want: dict = {}
    for d, o, r, s in rows:
        for n, cell in ((0, (r, s)), (1, ("GB", s)), (2, (r, "All Pubs")), (3, ("GB", "All Pubs"))):
            if cell[1] is not None:
                want.setdefault((d, n, *cell), set()).add(o)
    df = spark.createDataFrame(rows, "d string, outlet string, region string, segment string")
    cells = spark.createDataFrame(sorted({k[1:] for k in want}), f"{CELL_ID} int, region string, segment string")
    got = ros.outlets_per_cell(df, ["d"], "outlet", DimSpec(), cells, 4 * len(rows))
    assert {(x["d"], x[CELL_ID], x["region"], x["segment"]): x["outlet_count"] for x in got.collect()} == {k: len(v) for k, v in want.items()}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    by_outlet = [line for line in plan.splitlines() if "RepartitionByExpression" in line and "outlet" in line]
    assert by_outlet and by_outlet[0].rstrip().endswith(str(max(45, spark.sparkContext.defaultParallelism)))


def test_customers_are_joined_to_orders_and_not_to_every_sale(spark):
    from rosband.sources import retail

    plan = retail.sales_extract(retail.source_view(spark, SF))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    (at,) = [i for i, line in enumerate(plan) if "Join Inner" in line and "c_custkey" in line]
    below = []
    for line in plan[at + 1 :]:
        if depth(line) <= depth(plan[at]):
            break
        below.append(line)
    assert any("o_orderkey" in line for line in below) and not any("l_orderkey" in line for line in below)
