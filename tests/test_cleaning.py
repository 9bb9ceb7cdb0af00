"""Outlier removal, unit conversion, continuity (FIXTURES.md section 4)."""

from conftest import d
from pyspark.sql import functions as F

from rosband.functions.units import UnitRule
from rosband.operators.cleaning import continuous_items, drop_incomplete, remove_outliers, unit_volume

G = ["date", "region", "segment", "product"]


def _rows(values, outlet0=0, metric_other=1.0):
    # one group; value varies, volume constant-ish but not zero-variance
    return [
        (d(1), 2020, outlet0 + i, "P", "R", "S", "a", float(v), 1.0, float(metric_other + (i % 2)))
        for i, v in enumerate(values)
    ]


def test_single_row_and_constant_groups_vanish(sales):
    df = sales(
        [(d(1), 2020, 1, "ONE", "R", "S", "a", 5.0, 1.0, 1.0)]
        + [(d(1), 2020, i, "CONST", "R", "S", "a", 7.0, 1.0, 2.0) for i in range(20)]
    )
    assert remove_outliers(df, G, metrics=["value"]).count() == 0


def test_ten_rows_cannot_lose_a_row_but_more_can(sales):
    ten = sales(_rows([10] * 9 + [1000]))
    assert remove_outliers(ten, G, metrics=["value"]).count() == 10
    many = sales(_rows([10, 11] * 10 + [1000]))
    out = remove_outliers(many, G, metrics=["value"])
    assert out.count() == 20
    assert out.where(F.col("value") == 1000).count() == 0


def test_metric_order_matters(sales):
    # volume outlier only visible once the value outlier row is gone
    rows = [(d(1), 2020, i, "P", "R", "S", "a", 10.0 + (i % 2), 1.0, 5.0 + (i % 2)) for i in range(30)]
    rows.append((d(1), 2020, 98, "P", "R", "S", "a", 10_000.0, 1.0, 1000.0))
    rows.append((d(1), 2020, 99, "P", "R", "S", "a", 10.0, 1.0, 9.0))
    df = sales(rows)
    value_first = remove_outliers(df, G, metrics=["value", "volume"]).count()
    volume_first = remove_outliers(df, G, metrics=["volume", "value"]).count()
    assert (value_first, volume_first) == (30, 31)


def test_unit_rules_apply_in_sequence(sales):
    df = sales([(d(1), 2020, 1, "X", "R", "S", "a", 1.0, 2.0, 568.0 * 25)])
    twice = unit_volume(df, [UnitRule.per(["X"], 568), UnitRule.per(["X"], 25)])
    assert twice.first()["volume"] == 1.0
    to_qty = unit_volume(df, [UnitRule.per(["X"], 568), UnitRule.as_quantity(["X"])])
    assert to_qty.first()["volume"] == 2.0
    untouched = unit_volume(df, [UnitRule.per(["Y"], 568)])
    assert untouched.first()["volume"] == 568.0 * 25


def test_unit_rule_table(spark, sales):
    df = sales([(d(1), 2020, 1, "X", "R", "S", "a", 1.0, 2.0, 1136.0), (d(1), 2020, 1, "Z", "R", "S", "a", 1.0, 3.0, 50.0),
                (d(1), 2020, 1, "Q", "R", "S", "a", 1.0, 3.0, 50.0)])
    rules = spark.createDataFrame([("X", 568.0), ("Z", None)], "product string, divisor double")
    got = {r["product"]: r["volume"] for r in unit_volume(df, rules).collect()}
    assert got == {"X": 2.0, "Z": 3.0, "Q": 50.0}


def test_rule_table_with_two_rules_for_a_product(spark, sales):
    df = sales([(d(1), 2020, 1, "X", "R", "S", "a", 1.0, 2.0, 568.0 * 330), (d(1), 2020, 2, "Y", "R", "S", "a", 1.0, 3.0, 50.0)])
    rules = spark.createDataFrame([("X", 568.0), ("X", 330.0)], "product string, divisor double")
    assert sorted((r["outlet"], r["volume"]) for r in unit_volume(df, rules).collect()) == [(1, 1.0), (2, 50.0)]
    steps = spark.createDataFrame([("X", 568.0, 1), ("X", None, 2)], "product string, divisor double, step int")
    assert unit_volume(df, steps).where("outlet = 1").first()["volume"] == 2.0  # the later rule takes the quantity
    assert unit_volume(df, rules).columns == df.columns


def test_null_in_unused_column_removes_row(sales):
    df = sales([(d(1), 2020, 1, "P", "R", "S", None, 1.0, 1.0, 1.0), (d(1), 2020, 2, "P", "R", "S", "a", 1.0, 1.0, 1.0)])
    assert drop_incomplete(df).count() == 1


def test_continuity_threshold_is_strict(sales):
    rows = [(d(m), 2020, 1, "P", "R", "S", "a", 1.0, 1.0) for m in (1, 2)]  # 2 dates
    rows += [(d(m), 2020, 2, "P", "R", "S", "a", 1.0, 1.0) for m in (1, 2, 3)]  # 3 dates
    out = continuous_items(sales(rows), 2, item_column="product")
    assert sorted({r["outlet"] for r in out.collect()}) == [2]


def test_shuffle_join_gives_same_rows(spark, sales):
    rows = [(d(1 + i % 2), 2020, i, "P", "R", "S", "a", float(10 + i % 5), 1.0, float(1 + i % 3)) for i in range(40)]
    rows.append((d(1), 2020, 99, "P", "R", "S", "a", 500.0, 1.0, 2.0))
    df = sales(rows)
    small = sorted(map(tuple, remove_outliers(df, G, metrics=["value", "volume"]).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = remove_outliers(df, G, metrics=["value", "volume"])
        assert "SortMergeJoin" in big._jdf.queryExecution().executedPlan().toString()
        assert small == sorted(map(tuple, big.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_sigma_filter_matches_numpy(sales):
    import numpy as np

    rng = np.random.default_rng(11)
    rows = []
    for g in range(12):
        n = int(rng.integers(1, 40))
        for i in range(n):
            value = float(rng.normal(100, 10)) if rng.random() > 0.05 else float(rng.normal(100, 10) * 8)
            volume = float(rng.normal(50, 5)) if rng.random() > 0.05 else 900.0
            rows.append((d(1 + g % 3), 2020, 1000 * g + i, "P" + str(g // 3), "R", "S", "a", value, 1.0, volume))
    df = sales(rows)

    def keep(group, metric):
        x = np.array([r[{"value": 7, "volume": 9}[metric]] for r in group])
        if len(x) < 2:
            return []
        m, s = x.mean(), x.std(ddof=1)
        return [r for r, v in zip(group, x) if abs(m - v) < 3 * s]

    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[4], r[5], r[3]), []).append(r)
    expected = set()
    for grp in groups.values():
        expected |= {r[2] for r in keep(keep(grp, "volume"), "value")}
    got = {r["outlet"] for r in remove_outliers(df, G, metrics=["volume", "value"]).collect()}
    assert got == expected
