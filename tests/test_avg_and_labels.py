"""Average price, multi-region cells, labels, report lists."""

import pytest
from conftest import d
from pyspark.sql import Window
from pyspark.sql import functions as F

from rosband.functions.labels import keyword_rollup, product_label
from rosband.plans.avg_price import avg_price
from rosband.plans.report import report_lists
from rosband.schema import DimSpec, Thresholds

LOW = Thresholds(1, 1, 1.0)


def test_avg_price_is_unweighted_mean_of_row_prices(sales):
    df = sales([(d(1), 2020, 1, "P", "R", "S", "a", 1.0, 1.0), (d(1), 2020, 2, "P", "R", "S", "b", 27.0, 9.0)])
    st = avg_price(df, thresholds=LOW)
    row = st.cube.where((F.col("region") == "R") & (F.col("segment") == "S")).first()
    assert row["avg_price"] == 2.0


def test_avg_price_cube_has_all_rollups(sales):
    rows = [(d(1), 2020, i, "P", "R" + str(i % 2), "S" + str(i % 3), "p" + str(i % 3), 1.0 + i, 1.0) for i in range(12)]
    cube = avg_price(sales(rows), thresholds=LOW).cube
    regions = {r["region"] for r in cube.collect()}
    segs = {r["segment"] for r in cube.collect()}
    assert regions == {"R0", "R1", "GB"} and segs == {"S0", "S1", "S2", "All Pubs"}
    allall = cube.where((F.col("region") == "GB") & (F.col("segment") == "All Pubs")).first()
    assert allall["outlet_count"] == 12 and allall["data_partner_count"] == 3


def test_multi_regions_skip_non_members(spark):
    schema = ("date date, period int, outlet long, product string, region1 string, region2 string, segment string, "
              "data_partner string, value double, quantity double, volume double")
    rows = [(d(1), 2020, i, "P", "A" if i < 6 else "n", "n", "S", "p" + str(i % 3), 1.0 + i, 1.0, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, schema)
    st = avg_price(df, dims=DimSpec.multi(["region1", "region2"]), thresholds=LOW)
    got = {(r["region"], r["segment"]): r["outlet_count"] for r in st.cube.collect()}
    assert got == {("A", "S"): 6, ("A", "All Pubs"): 6}


def test_keyword_rollup_case_and_null(spark):
    df = spark.createDataFrame([("Blue WIDGET",), ("small gear",), (None,), ("red rod",)], "n string")
    got = [r[0] for r in df.select(keyword_rollup("n", [("widget", "Any Widget"), ("gear", "Any Gear")])).collect()]
    assert got == ["Any Widget", "Any Gear", None, "red rod"]


def test_product_label_null_part_gives_null(spark):
    df = spark.createDataFrame([("X", "pint", "Draught"), ("X", "25ml", "Other"), ("X", None, "Draught")], "p string, s string, f string")
    got = [r[0] for r in df.select(product_label("p", "s", "f", ["Draught", "Packaged"])).collect()]
    assert got == ["Draught X pint", "X 25ml", None]


def test_report_lists_pad_short_lists(spark):
    rows = [("r" + str(i % 2), "s" + str(i % 3), "p" + str(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "region string, segment string, product string")
    out = sorted(report_lists(df, ["region", "segment", "product"]).collect(), key=lambda r: r["position"])
    assert len(out) == 6
    assert [r["region"] for r in out] == ["r0", "r1", None, None, None, None]
    assert [r["segment"] for r in out][:3] == ["s0", "s1", "s2"] and out[3]["segment"] is None


def test_multi_naming_with_one_region_column(spark):
    schema = ("date date, period int, outlet long, product string, region1 string, segment string, "
              "data_partner string, value double, quantity double, volume double")
    rows = [(d(1), 2020, i, "P", "A" if i < 6 else "n", "S", "p" + str(i % 3), 1.0 + i, 1.0, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, schema)
    st = avg_price(df, dims=DimSpec.multi(["region1"]), thresholds=LOW)
    got = {(r["region_dim"], r["region"], r["segment"]): r["outlet_count"] for r in st.cube.collect()}
    assert got == {("region1", "A", "S"): 6, ("region1", "A", "All Pubs"): 6}


def test_equal_labels_of_two_region_columns_stay_apart(spark):
    schema = ("date date, period int, outlet long, product string, region1 string, region2 string, segment string, "
              "data_partner string, value double, quantity double, volume double")
    rows = [(d(1), 2020, i, "P", "North" if i < 6 else "n", "North" if i < 3 else "n", "S", "p", 1.0 + i, 1.0, 1.0) for i in range(9)]
    st = avg_price(spark.createDataFrame(rows, schema), dims=DimSpec.multi(["region1", "region2"]), thresholds=LOW)
    got = {(r["region_dim"], r["region"]): r["outlet_count"] for r in st.published.where("segment = 'S'").collect()}
    assert got == {("region1", "North"): 6, ("region2", "North"): 3}


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ordinal_is_dense_and_ordered(spark, reuse):
    from rosband.plans.report import ordinal

    n = 300_000  # enough for the range partitioning to sample
    df = spark.range(0, n).select((F.col("id") * 7 % n).cast("string").alias("k")).repartition(7)
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = ordinal(df, "k")
        before = Window.orderBy("position")
        out = got.select("position", "k", F.lag("k").over(before).alias("p"))
        r = out.agg(
            F.count_distinct("position").alias("d"), F.min("position").alias("a"), F.max("position").alias("b"),
            F.sum((F.col("p") >= F.col("k")).cast("long")).alias("bad"),
        ).first()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert (r["d"], r["a"], r["b"], r["bad"]) == (n, 1, n, 0)
