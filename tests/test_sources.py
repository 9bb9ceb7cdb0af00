"""Sources: selection tables, JDBC options, snapshots."""

import os
import tempfile

import pytest
from conftest import d

from rosband.sources.jdbc import jdbc_options
from rosband.sources.selection import select_products_multi, selection_table
from rosband.sources.snapshot import snapshot


def test_multi_selection_any_format_and_case(spark):
    rows = [("Gin", "25ml", "packaged"), ("gin", "25ml", "draught"), ("Ale", "pint", "draught"), ("Ale", "pint", "packaged"),
            ("Ale", "25ml", "draught")]
    df = spark.createDataFrame(rows, "product string, size string, format string")
    sel = selection_table(spark, [("GIN", "25ml"), ("Ale", "pint", "Draught")])
    got = sorted(tuple(r) for r in select_products_multi(df, sel).collect())
    assert got == [("Ale", "pint", "draught"), ("Gin", "25ml", "packaged"), ("gin", "25ml", "draught")]


def test_jdbc_options():
    o = jdbc_options("jdbc:x", dbtable="t", partition_column="id", lower_bound=0, upper_bound=10, num_partitions=4)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", query="select 1", partition_column="id", lower_bound=0, upper_bound=1, num_partitions=2)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_snapshot_computes_once(spark, sales):
    path = os.path.join(tempfile.mkdtemp(prefix="rosband-snap-"), "fact")
    calls = []

    def compute(_s):
        calls.append(1)
        return sales([(d(1), 2020, 1, "P", "R", "S", "a", 1.0, 1.0)])

    assert snapshot(spark, path, compute, partition_by=["period"]).count() == 1
    assert snapshot(spark, path, compute).count() == 1
    assert len(calls) == 1
    snapshot(spark, path, compute, refresh=True)
    assert len(calls) == 2


def test_extract_filters_and_casts(spark):
    import os

    from rosband.schema import SALES_SCHEMA, conform
    from rosband.sources import retail

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    v = retail.source_view(spark, sf)
    all_rows = retail.sales_extract(v, guards=False)
    core = retail.sales_extract(v, categories=["AUTOMOBILE", "BUILDING"], guards=False)
    assert {r["segment"] for r in core.select("segment").distinct().collect()} == {"Core"}
    assert 0 < core.count() < all_rows.count()
    late = retail.sales_extract(v, date_from="2000-01-01", guards=False)
    assert late.where("date < DATE'2000-01-01'").count() == 0
    small = retail.sales_extract(v, products=["SMALL"], guards=False)
    assert {r[0] for r in small.select("product").distinct().collect()} == {"SMALL"}
    c = conform(all_rows)
    assert [c.schema[f.name].dataType for f in SALES_SCHEMA.fields] == [f.dataType for f in SALES_SCHEMA.fields]


def test_report_sinks_write_datasets(spark, tmp_path):
    from rosband.plans.report import write_report

    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    write_report({"PC_Data": df, "lists": df}, str(tmp_path / "parquet"))
    write_report({"OT_Data": df}, str(tmp_path / "csv"), fmt="csv")
    assert spark.read.parquet(str(tmp_path / "parquet" / "lists")).count() == 1
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv" / "OT_Data")).count() == 1


def test_job_handle_deletes_its_datasets(spark):
    from rosband.operators.joins import Datasets, materialize

    own, other = Datasets(spark), Datasets(spark)
    with own.active():
        df = materialize(spark.range(10).selectExpr("id", "cast(id as string) s"))
        with other.active():
            kept = materialize(spark.range(3))
    assert df.count() == 10 and len(own.paths) == 1 and len(other.paths) == 1
    path = own.paths[0]
    assert own.close() == 1 and own.paths == []
    assert not os.path.exists(path.removeprefix("file:"))
    assert kept.count() == 3 and other.close() == 1


def test_a_query_leaves_nothing_behind_once_closed(spark):
    from rosband.plans.registry import owned

    df, datasets = owned("price_bands", spark, "/root/testdata/sf0.001")
    df.collect()
    paths = list(datasets.paths)
    assert paths and datasets.close() == len(paths)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in paths)


def test_partition_values_keep_their_types(spark):
    from rosband.operators.joins import materialize

    df = spark.createDataFrame([("01", 1.0), ("02", 2.0)], "period string, v double")
    assert sorted(map(tuple, materialize(df, ["period"]).select("period", "v").collect())) == [("01", 1.0), ("02", 2.0)]
    path = os.path.join(tempfile.mkdtemp(prefix="rosband-snap-"), "s")
    for _ in range(2):
        got = snapshot(spark, path, lambda _s: df, partition_by=["period"])
        assert got.schema == df.schema and sorted(r["period"] for r in got.collect()) == ["01", "02"]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from rosband.session import checkpoint_dir

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=dict)
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_extract_over_a_view_with_other_names(spark):
    """A table of the source's shape (as a JDBC frame would have it) with its own column names."""
    import datetime as dt

    from rosband.sources import retail

    rows = [(dt.date(2020, 1, 6), 1, 10, "Ale", "BUILDING", "UK", "North", "p1", 5.0, 2.0, 568.0),
            (dt.date(2020, 1, 6), 1, 10, "Ale", "BUILDING", "UK", "North", "p1", 7.0, 1.0, 568.0),
            (dt.date(2019, 1, 6), 1, 10, "Ale", "BUILDING", "UK", "North", "p1", 7.0, 1.0, 568.0),
            (dt.date(2020, 1, 6), 0, 10, "Ale", "BUILDING", "UK", "North", "p1", 7.0, 1.0, 568.0),
            (dt.date(2020, 1, 6), 2, 10, "Ale", "FOOD", "UK", "North", "p1", 7.0, 1.0, 568.0),
            (dt.date(2020, 1, 6), 2, 10, "Ale", "BUILDING", "FR", "North", "p1", 7.0, 1.0, 568.0)]
    view = spark.createDataFrame(
        rows, "day date, shop long, item_no long, item string, kind string, land string, area string, partner string, "
        "money double, pieces double, ml double")  # fmt: skip
    spec = retail.ViewSpec("day", "shop", "item_no", "item", "kind", "land", "partner", "money", "pieces", "ml", hidden=("kind",))
    got = retail.sales_extract(
        view, spec, region="area", with_calendar=False, date_from="2020-01-01", categories=["BUILDING"], country="UK", products=["Ale"]
    ).collect()
    assert [(r["outlet"], r["region"], r["segment"], r["value"], r["quantity"], r["volume"]) for r in got] == [
        (1, "North", "Core", 12.0, 3.0, 1136.0)
    ]


def test_whole_job_writes_and_csv(spark, sales, tmp_path):
    from rosband.functions.units import UnitRule
    from rosband.plans.job import price_report
    from rosband.schema import Thresholds

    rows = [(d(m), 2020, i, "P", "R" + str(i % 2), "S", "abc"[i % 3], float(10 + i % 7), 1.0 + i % 3) for m in (1, 2) for i in range(40)]
    root = str(tmp_path / "job")
    price_report(
        spark, root, lambda _s: sales(rows), ["date", "region", "segment", "product"], [UnitRule.per(["P"], 2)], [2020],
        thresholds=Thresholds(1, 1, 1.0), fmt="csv",
    )
    for name in ("PC_Data", "OT_Data", "lists", "edges", "banded", "totals"):
        assert spark.read.option("header", "true").csv(f"{root}/{name}").count() > 0, name


def test_keys_that_others_decide_are_not_grouped_by(spark):
    """Period, quarter, year and segment come from the aggregated rows, equal to grouping by them."""
    from pyspark.sql import functions as F

    from rosband.sources import retail

    view = retail.source_view(spark, "/root/testdata/sf0.001")
    for build, grain in ((retail.sales_extract, "month"), (retail.sales_extract_multi, "quarter")):
        got = build(view)
        whole = {**retail._calendar(retail.STAR, grain), "segment": retail.segment_expr()}
        whole = {n: e for n, e in whole.items() if n in got.columns}
        plain = view.where("o_custkey > 0 and l_partkey > 0 and l_quantity > 0 and l_extendedprice > 0")
        by = [e.alias(n) for n, e in whole.items()]
        want = plain.groupBy(*by).agg(F.sum("l_quantity").cast("long").alias("n"))
        sums = got.groupBy(*[c for c in whole]).agg(F.sum("quantity").cast("long").alias("n"))
        assert {tuple(r) for r in sums.collect()} == {tuple(r) for r in want.select(*sums.columns).collect()}
        grouping = got._jdf.queryExecution().analyzed().toString().split("Aggregate [", 1)[1].split("]")[0]
        assert "year(" not in grouping and "CASE WHEN c_mktsegment" not in grouping and "mktsegment" in grouping


def test_snapshot_keeps_its_schema_without_python_rows(spark, tmp_path, monkeypatch):
    from rosband.sources.snapshot import snapshot

    def no_rows(*_a, **_k):
        raise AssertionError("rows sent from Python")

    monkeypatch.setattr(type(spark), "createDataFrame", no_rows)
    got = snapshot(spark, str(tmp_path / "s"), lambda s: s.range(3).selectExpr("id", "'0' || id as period"), partition_by=["period"])
    assert sorted(tuple(r) for r in got.collect()) == [(0, "00"), (1, "01"), (2, "02")]
