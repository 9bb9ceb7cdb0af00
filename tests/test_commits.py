"""Versioned periods, committed reports and counts taken while rows are written."""

import pytest
from conftest import d

from rosband.operators.cleaning import outlier_report, remove_outliers, remove_outliers_counted
from rosband.plans.job import sales_report
from rosband.plans.report import ReportRun, read_sheet
from rosband.schema import Thresholds
from rosband.sources import manifest
from rosband.sources.snapshot import incremental_snapshot, vacuum

GROUPS = ["date", "region", "segment", "product"]


class Source:
    """A sales table by period that remembers which periods were pulled."""

    def __init__(self, spark, rows):
        self.spark, self.rows, self.pulls = spark, rows, []

    def __call__(self, spark, periods):
        self.pulls.append(sorted(periods))
        return spark.createDataFrame([r for r in self.rows if r[0] in periods], "period int, outlet long")


def rows_of(df):
    return sorted(map(tuple, df.select("period", "outlet").collect()))


def test_only_changed_periods_are_pulled(spark, tmp_path):
    path = str(tmp_path / "s")
    src = Source(spark, [(2019, 1), (2020, 2), (2021, 3)])
    versions = {2019: "a", 2020: "a", 2021: "a"}
    assert rows_of(incremental_snapshot(spark, path, src, versions)) == src.rows
    assert rows_of(incremental_snapshot(spark, path, src, versions)) == src.rows
    assert src.pulls == [[2019, 2020, 2021]]
    src.rows = [(2019, 1), (2020, 20), (2020, 21), (2021, 99)]
    got = incremental_snapshot(spark, path, src, {**versions, 2020: "b"})
    assert rows_of(got) == [(2019, 1), (2020, 20), (2020, 21), (2021, 3)]  # 2021 has no new version
    assert src.pulls[1:] == [[2020]]
    src.rows = []
    assert rows_of(incremental_snapshot(spark, path, src, {**versions, 2020: "c"})) == [(2019, 1), (2021, 3)]
    assert rows_of(incremental_snapshot(spark, path, src, {2019: "a"})) == [(2019, 1)]  # two periods left the source
    assert len(src.pulls) == 3
    assert vacuum(spark, path) == 2
    assert rows_of(incremental_snapshot(spark, path, src, {2019: "a"})) == [(2019, 1)]


def test_a_failed_pull_leaves_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "s")
    src = Source(spark, [(2019, 1), (2020, 2)])
    incremental_snapshot(spark, path, src, {2019: 1, 2020: 1})

    def dies(_spark, _periods):
        return spark.range(4).selectExpr("2020 as period", "if(id = 3, raise_error('lost'), id) as outlet")

    with pytest.raises(Exception, match="lost"):
        incremental_snapshot(spark, path, dies, {2019: 1, 2020: 2})
    assert rows_of(incremental_snapshot(spark, path, src, {2019: 1, 2020: 1})) == src.rows
    assert len(src.pulls) == 1
    with pytest.raises(ValueError, match="schema"):
        incremental_snapshot(spark, path, lambda s, p: s.createDataFrame([(2020, "x")], "period int, outlet string"), {2020: 3})
    with pytest.raises(ValueError, match="schema"):
        incremental_snapshot(spark, str(tmp_path / "none"), src, {})


def test_unchanged_periods_are_pruned_by_directory(spark, tmp_path):
    path = str(tmp_path / "s")
    src = Source(spark, [(p, p) for p in range(2000, 2010)])
    versions = {p: 1 for p in range(2000, 2010)}
    incremental_snapshot(spark, path, src, versions)
    df = incremental_snapshot(spark, path, src, {**versions, 2004: 2})
    assert len(df.where("period = 2004").inputFiles()) >= 1
    plan = df.where("period = 2004")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and rows_of(df.where("period = 2004")) == [(2004, 2004)]


def test_a_report_is_seen_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "r")
    old, new = spark.range(2), spark.range(5)
    with pytest.raises(LookupError):
        read_sheet(spark, root, "a")
    with ReportRun(spark, root) as run:
        run.write({"a": old, "b": old})
    failed = ReportRun(spark, root)
    with pytest.raises(RuntimeError), failed:
        failed.write({"a": new})
        assert read_sheet(spark, root, "a").count() == 2  # not committed yet
        raise RuntimeError("between two sheets")
    assert not (tmp_path / "r" / failed.name).exists()
    assert [read_sheet(spark, root, n).count() for n in "ab"] == [2, 2]
    with ReportRun(spark, root, "csv") as run:
        run.write({"a": new})
    got = read_sheet(spark, root, "a")
    assert got.schema.simpleString() == new.schema.simpleString() and got.count() == 5
    with pytest.raises(LookupError):
        read_sheet(spark, root, "b")  # not a sheet of the newest version
    assert manifest.current(spark, root)["run"] == run.name


def rows(n=40):
    out = [(d(m), 2020, i, "P", "R" + str(i % 2), "S", "abc"[i % 3], float(10 + i % 7), 1.0 + i % 3) for m in (1, 2) for i in range(n)]
    return [*out, (d(1), 2020, 900, "P", "R0", "S", "a", 9000.0, 1.0), (d(1), 2020, 901, "P", "R0", "S", "a", 10.0, 5000.0),
            (d(2), 2020, 902, "P", "R0", "S", None, 10.0, 1.0), (d(2), 2020, 903, "Q", "R0", "S", "a", 10.0, 1.0)]


def test_counts_of_the_filters(sales):
    df = sales(rows())
    out, removed = remove_outliers_counted(df, GROUPS, metrics=["volume", "value"])
    want = remove_outliers(df, GROUPS, metrics=["volume", "value"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    first = remove_outliers(df, GROUPS, metrics=["volume"]).count()
    n = len(rows()) - 1  # one row has a null
    steps = [tuple(r) for r in removed.orderBy("step").collect()]
    assert steps == [(1, "volume", n, n - first), (2, "value", first, first - want.count())]
    assert all(s[3] > 0 for s in steps)
    assert sum(r["rows_removed"] for r in outlier_report(df, want).collect()) == steps[0][3] + steps[1][3]


def test_counts_of_an_empty_table(sales):
    out, removed = remove_outliers_counted(sales([]), GROUPS, metrics=["volume", "value"])
    assert out.count() == 0
    assert [tuple(r) for r in removed.orderBy("step").collect()] == [(1, "volume", 0, 0), (2, "value", 0, 0)]


def test_both_reports_from_one_pull(spark, sales, tmp_path):
    pulls = []

    def pull(_spark):
        pulls.append(1)
        return sales(rows())

    root = str(tmp_path / "job")
    args = {"periods": [2020], "thresholds": Thresholds(1, 1, 1.0)}
    run = sales_report(spark, root, pull, GROUPS, [], **args)
    assert len(pulls) == 1
    assert sorted(run.sheets) == sorted(["removed", "edges", "banded", "totals", "PC_Data", "avg", "OT_Data", "lists", "avg_lists"])
    for name in run.sheets:
        assert read_sheet(spark, root, name).count() > 0, name
    again = sales_report(spark, root, pull, GROUPS, [], **args)
    assert len(pulls) == 1 and again.name != run.name
    with pytest.raises(ValueError, match="date"):
        sales_report(spark, root, pull, ["region"], [], **args)
