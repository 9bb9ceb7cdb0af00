"""Unit conversion, null removal, sigma outlier filter and continuity filter."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rosband.functions.units import UnitRule, apply_rules
from rosband.operators.joins import attach, materialize
from rosband.schema import OUTLIER_DEFAULT_METRICS, Columns, require_columns


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Remove rows with a null in any column."""
    return df.na.drop(how="any")


def unit_volume(df: DataFrame, rules: Sequence[UnitRule] | DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Convert ``volume`` into serving units.

    ``rules`` is either a sequence of ``UnitRule`` (applied in order) or a rule table with columns
    ``product``, ``divisor`` (null: volume := quantity) and optionally ``step``.  A product's rules are
    applied one after the other by ``step``, then ascending divisor (nulls first), as the sequence form does;
    the table is folded to one row per product, so no sale is repeated.
    """
    if isinstance(rules, DataFrame):
        step = F.col("step") if "step" in rules.columns else F.lit(0)
        rule = F.struct(step.cast("int").alias("step"), F.col("divisor").cast("double").alias("divisor"))
        table = rules.groupBy(F.col("product").alias("__rule_product")).agg(F.array_sort(F.collect_list(rule)).alias("__rules"))
        joined = attach(df.withColumn("__rule_product", F.col(cols.product)), table, ["__rule_product"], "left")
        volume, quantity = F.col(cols.volume).cast("double"), F.col(cols.quantity).cast("double")
        folded = F.aggregate(
            "__rules", volume, lambda v, r: F.when(r["divisor"].isNull(), quantity).otherwise(v / r["divisor"])
        )
        new_volume = F.when(F.col("__rules").isNull(), volume).otherwise(folded)
        return joined.withColumn(cols.volume, new_volume).drop("__rule_product", "__rules").select(*df.columns)
    expr = apply_rules(F.col(cols.product), F.col(cols.volume), F.col(cols.quantity), list(rules))
    return df.withColumn(cols.volume, expr)


def _sigma_step(df: DataFrame, group_columns: Sequence[str], metric: str, st_devs: float) -> DataFrame:
    """Keep rows with ``|mean - x| < st_devs * stddev_samp`` within their group.

    Mean and sample deviation come from a partial (map-side) aggregation and are joined back; a hot group
    never lands in a single task as it would with a window over the group.
    """
    stats = df.groupBy(*group_columns).agg(F.avg(metric).alias("__mean"), F.stddev_samp(metric).alias("__std"))
    joined = attach(df, materialize(stats), group_columns)
    keep = F.abs(F.col("__mean") - F.col(metric)) < F.lit(float(st_devs)) * F.col("__std")
    return joined.where(keep).drop("__mean", "__std").select(*df.columns)


def remove_outliers(
    df: DataFrame,
    group_columns: Sequence[str],
    unit_rules: Sequence[UnitRule] | DataFrame = (),
    metrics: Sequence[str] | None = None,
    st_devs: float = 3,
    cols: Columns = Columns(),
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Null removal, unit conversion, then one sigma filter per metric in order.

    The second metric's statistics are computed on the rows that survived the first.  Single-row groups
    (null deviation) and constant groups (zero deviation) are removed, because the strict comparison is never
    true.  The input is read once per metric and once for the result: pass a written table (``materialize``)
    when building it is expensive.  ``watch`` is applied to the complete rows and to what each metric leaves.
    """
    require_columns(df, list(group_columns))
    metrics = list(OUTLIER_DEFAULT_METRICS if metrics is None else metrics)
    out = drop_incomplete(df)
    if isinstance(unit_rules, DataFrame) or unit_rules:
        out = unit_volume(out, unit_rules, cols)
    out = watch(out)
    for m in metrics:
        out = watch(_sigma_step(out, group_columns, m, st_devs))
    return out


def remove_outliers_counted(
    df: DataFrame,
    group_columns: Sequence[str],
    unit_rules: Sequence[UnitRule] | DataFrame = (),
    metrics: Sequence[str] | None = None,
    st_devs: float = 3,
    cols: Columns = Columns(),
    partition_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``remove_outliers`` written, and ``step, metric, rows_in, rows_removed`` of each metric's filter.

    The rows are counted as they pass while the result is written (``DataFrame.observe``), so nothing is read or
    aggregated for the report.  Rows of a shuffle stage that is computed again after the loss of an executor may be counted
    twice: the counts are a report of the run, ``outlier_report`` counts exactly.
    """
    metrics = list(OUTLIER_DEFAULT_METRICS if metrics is None else metrics)
    seen: list[Observation] = []

    def watch(rows: DataFrame) -> DataFrame:
        seen.append(Observation())
        return rows.observe(seen[-1], F.count(F.lit(1)).alias("rows"))

    out = materialize(remove_outliers(df, group_columns, unit_rules, metrics, st_devs, cols, watch), partition_by)
    # a step that no row can reach is taken out of the plan and has no count
    rows = [o._jo.getAsJava().get("rows") or 0 for o in seen]
    steps = [(i + 1, m, rows[i], rows[i] - rows[i + 1]) for i, m in enumerate(metrics)]
    return out, df.sparkSession.createDataFrame(steps, "step int, metric string, rows_in long, rows_removed long")


def outlier_report(before: DataFrame, after: DataFrame, by: Sequence[str] = ("product",)) -> DataFrame:
    """Rows in / rows removed per key (the analysed job prints one total)."""
    keys = list(by)
    n_in = drop_incomplete(before).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_in"))
    n_out = after.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_out"))
    return (
        n_in.join(n_out, keys, "left")
        .select(*keys, "rows_in", (F.col("rows_in") - F.coalesce(F.col("rows_out"), F.lit(0))).alias("rows_removed"))
    )


def continuous_items(
    df: DataFrame,
    date_count_threshold: int = 2,
    item_column: str = "brand",
    date_column: str = "date",
    format_column: str = "format",
    outlet_column: str = "outlet",
    period_column: str = "period",
) -> DataFrame:
    """Keep rows whose (outlet, period, format, item) group -- whichever of these
    columns exist, in frame order -- has strictly more than ``threshold`` distinct dates.

    Distinct dates come from a grouped aggregation (deduplicated map-side per
    key and date).  The qualifying keys are written and applied with a left-semi
    join, which the planner broadcasts or shuffles by their size.
    """
    wanted = {outlet_column, period_column, format_column, item_column}
    keys = [c for c in df.columns if c in wanted]
    if not keys:
        raise ValueError("none of the continuity key columns is present")
    qualifying = (
        df.groupBy(*keys)
        .agg(F.count_distinct(date_column).alias("__dates"))
        .where(F.col("__dates") > F.lit(int(date_count_threshold)))
        .select(*keys)
    )
    return attach(df, materialize(qualifying), keys, "left_semi")
