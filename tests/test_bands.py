"""Band edges, assignment, ROS and suppression on hand-made rows."""

from conftest import d
from pyspark.sql import functions as F

from rosband.operators.bands import edges_wide, quantile_edges
from rosband.plans.price_bands import price_bands
from rosband.schema import DEFAULT_QUANTILES, Thresholds

LOW = Thresholds(1, 1, 1.0)


def test_edges_interpolate_linearly(spark):
    prices = [1.0, 1.0, 2.5, 3.1, 3.1, 4.7, 9.9, 10.0]
    df = spark.createDataFrame([(1, p) for p in prices], "k int, price double")
    e = edges_wide(quantile_edges(df, ["k"], DEFAULT_QUANTILES), ["k"], DEFAULT_QUANTILES).first()
    assert [round(e[c], 6) for c in ("q20", "q40", "q60", "q80", "q100")] == [1.6, 2.98, 3.42, 7.82, 10.0]


def test_equal_prices_all_in_lowest_band(sales):
    rows = [(d(1), 2020, i, "P", "R", "S", "a", 2.0, 1.0) for i in range(6)]
    st = price_bands(sales(rows), thresholds=LOW)
    assert {r["percentile"] for r in st.banded.collect()} == {0.2}
    joined = st.joined.where((F.col("region") == "R") & (F.col("segment") == "S")).collect()
    assert len(joined) == 5
    assert {r["percentile"] for r in joined if r["outlet_count"] is not None} == {0.2}
    assert {r["percentile"] for r in st.published.collect()} == {0.2}


def test_row_lands_in_one_band_per_cell(sales):
    rows = [(d(m), 2020, i, "P", "R" + str(i % 2), "S" + str(i % 3), "p" + str(i % 4), float(1 + i), 1.0)
            for m in (1, 2) for i in range(12)]
    st = price_bands(sales(rows), thresholds=LOW)
    b = st.banded
    assert b.count() == 24 * 4
    per = b.groupBy("date", "outlet", "data_partner", "region", "segment").count()
    assert per.where(F.col("count") != 1).count() == 0


def test_outlet_in_two_bands_counted_once_in_total(sales):
    # outlet 0 is cheap in January and expensive in February
    rows = []
    for m, p0 in ((1, 1.0), (2, 100.0)):
        rows.append((d(m), 2020, 0, "P", "R", "S", "a", p0, 1.0))
        rows += [(d(m), 2020, i, "P", "R", "S", "a", 50.0 + i, 1.0) for i in range(1, 5)]
    st = price_bands(sales(rows), thresholds=LOW)
    pub = st.joined.where((F.col("region") == "R") & (F.col("segment") == "S"))
    r = {row["percentile"]: row for row in pub.collect()}
    assert r[0.2]["total_outlet_count"] == 5
    assert r[0.2]["outlet_count"] == 2 and r[1.0]["outlet_count"] == 2


def test_empty_week_excluded_from_mean(sales):
    # two weeks; band 1.0 only non-empty in week 1 in the cell (R, S)
    rows = [
        (d(1), 2020, 1, "P", "R", "S", "a", 1.0, 1.0), (d(1), 2020, 2, "P", "R", "S", "a", 5.0, 1.0, 10.0),
        (d(2), 2020, 1, "P", "R", "S", "a", 3.0, 1.0), (d(2), 2020, 2, "P", "R", "S", "a", 3.0, 1.0),
    ]
    st = price_bands(sales(rows), metrics=["volume"], thresholds=LOW)
    pr = {r["percentile"]: r["volume_ros"] for r in st.period_ros.where((F.col("region") == "R") & (F.col("segment") == "S")).collect()}
    assert pr[1.0] == 10.0  # only week 1
    assert pr[0.2] == 1.0  # week 1: outlet 1 (1.0); week 2: both at 3.0 -> (1 + 1) / 2 = 1


def test_partner_tie_drops_cell_and_keep_policy(sales):
    rows = [(d(1), 2020, i, "P", "R", "S", "ab"[i % 2], 1.0, 1.0) for i in range(4)]
    df = sales(rows)
    assert price_bands(df, thresholds=LOW).dominance.count() == 0
    kept = price_bands(df, thresholds=LOW, tie_policy="keep").dominance
    assert {r["nda_data_partner_with_max_share"] for r in kept.collect()} == {"a"}


def test_suppression_boundaries_are_inclusive(sales):
    # 50 outlets, partners a/b/c with volume shares 0.5 / 0.3 / 0.2
    rows = []
    for i in range(50):
        p = "a" if i < 25 else ("b" if i < 40 else "c")
        rows.append((d(1), 2020, i, "P", "R", "S", p, 2.0, 1.0, 1.0))
    st = price_bands(sales(rows), thresholds=Thresholds(50, 3, 0.5))
    pub = st.published.where((F.col("region") == "R") & (F.col("segment") == "S")).collect()
    assert len(pub) == 1 and pub[0]["outlet_count"] == 50
    assert price_bands(sales(rows), thresholds=Thresholds(51, 3, 0.5)).published.count() == 0
    assert price_bands(sales(rows), thresholds=Thresholds(50, 4, 0.5)).published.count() == 0
    assert price_bands(sales(rows), thresholds=Thresholds(50, 3, 0.49)).published.count() == 0


def test_period_filter_and_no_dimensions(sales):
    rows = [(d(1, y), y, i, "P", "R", "S", "a", float(i + 1), 1.0) for y in (2019, 2020) for i in range(5)]
    df = sales(rows).drop("region", "segment")
    from rosband.schema import DimSpec

    st = price_bands(df, period_filter=[2020], dims=DimSpec(regions=(), segments=()), thresholds=LOW)
    assert {r["period"] for r in st.joined.collect()} == {2020}
    assert "region" not in st.published.columns


def test_item_filter_and_two_item_levels(spark):
    rows = [(d(1), 2020, i, "P" + str(i % 2), "B" + str(i % 3), "R", "S", "a", float(i + 1), 1.0, 1.0) for i in range(12)]
    df = spark.createDataFrame(
        rows, "date date, period int, outlet long, product string, brand string, region string, segment string, "
        "data_partner string, value double, quantity double, volume double")
    st = price_bands(df, item_columns=["product", "brand"], items=["P0", "B1"], thresholds=LOW)
    got = {(r["product_type"], r["product"]) for r in st.band_prices.collect()}
    assert got == {("product", "P0"), ("brand", "B1")}


def test_multi_keep_all_regions_counts_each_row_once(spark):
    from rosband.schema import DimSpec

    schema = ("date date, period int, outlet long, product string, region1 string, region2 string, segment string, "
              "data_partner string, value double, quantity double, volume double")
    rows = [(d(1), 2020, i, "P", "A", "B", "S", "p", float(i + 1), 1.0, 1.0) for i in range(8)]
    df = spark.createDataFrame(rows, schema)
    spec = DimSpec(regions=("region1", "region2"), segments=("segment",), not_member="n", keep_all_regions=True)
    st = price_bands(df, dims=spec, thresholds=LOW)
    tot = {(r["region"], r["segment"]): r["total_outlet_count"] for r in st.totals.collect()}
    assert tot[("GB", "All Pubs")] == 8 and tot[("A", "S")] == 8 and tot[("B", "All Pubs")] == 8
    assert st.labelled.where("region = 'GB' AND segment = 'All Pubs'").count() == 8


def test_edges_match_numpy_linear_percentile_with_ties(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    rows, expect = [], {}
    for g in range(25):
        n = int(rng.integers(1, 60))
        vals = np.round(rng.choice([1.0, 2.5, 3.25, 7.0, 9.99], n) + rng.integers(0, 3, n), 2)  # many ties
        rows += [(g, float(v)) for v in vals]
        expect[g] = np.percentile(vals, [20, 40, 60, 80, 100], method="linear")
    df = spark.createDataFrame(rows, "k int, price double")
    got = {r["k"]: r["edges"] for r in quantile_edges(df, ["k"], DEFAULT_QUANTILES).collect()}
    for g, e in expect.items():
        assert np.allclose(got[g], e, rtol=0, atol=1e-9), (g, got[g], e)


def test_single_dimension_cube(sales):
    rows = [(d(1), 2020, i, "P", "R" + str(i % 2), "S", "a", float(i + 1), 1.0) for i in range(10)]
    df = sales(rows).drop("segment")
    st = price_bands(df, thresholds=LOW)
    regions = {r["region"] for r in st.band_prices.collect()}
    assert regions == {"R0", "R1", "GB"} and "segment" not in st.published.columns
    assert st.totals.where("region = 'GB'").first()["total_outlet_count"] == 10
