"""Roll-up expansion: one output row per (row, cell it belongs to).

A cube over the present dimension columns is a set of grouping sets.  Instead
of Spark's ``CUBE`` (which would be run separately for every statistic) the
rows are expanded once with ``explode`` over an array of label structs, and
every later aggregate is a plain ``groupBy`` on the labelled rows; the same
labelled rows also drive the band-assignment join.  This is what Spark's
``Expand`` operator does for grouping sets, made reusable.

Each expanded row carries ``cell_id``, an integer that identifies the grouping
set (and, with several region columns, the dimension pair).  It is part of
every key, so a roll-up member can never merge with a real member that happens
to carry the same label.

Statistics whose parts can be merged need no expansion of rows: ``roll_up``
makes the cells from rows aggregated at the finest grain, parents from children.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product as cartesian

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosband.schema import DimSpec

CELL_ID = "cell_id"


@dataclass(frozen=True)
class Cells:
    """Result of an expansion: the frame and its cell key columns."""

    df: DataFrame
    labels: tuple[str, ...]  # output label columns, e.g. ("region", "segment")

    @property
    def keys(self) -> list[str]:
        return [CELL_ID, *self.labels]


@dataclass(frozen=True)
class Option:
    """One way in which a row takes part in an axis: by the member in ``source``, or in the roll-up (no source)."""

    number: int  # what it adds to the cell id
    labels: dict[str, Column]
    conditions: tuple[Column, ...] = ()
    source: str | None = None


def axes(df: DataFrame, spec: DimSpec) -> list[list[Option]]:
    """The options of every present dimension; the cells of a row are the combinations of one option of each."""
    regions = [c for c in spec.regions if c in df.columns]
    segments = [c for c in spec.segments if c in df.columns]

    def member(col: str, number: int, labels: dict[str, Column], is_region: bool) -> Option:
        conditions = [F.col(col).isNotNull()]
        if is_region and spec.not_member is not None:
            conditions.append(~F.col(col).eqNullSafe(spec.not_member))
        return Option(number, labels, tuple(conditions), col)

    if not _shared(regions, segments, spec):
        out = []
        present = [(c, spec.all_regions, True) for c in regions[:1]] + [(c, spec.all_segments, False) for c in segments[:1]]
        for bit, ((col, all_label, is_region), name) in enumerate(zip(present, label_names(df, spec), strict=True)):
            options = [member(col, 0, {name: F.col(col)}, is_region)]
            if not is_region or spec.keep_all_regions:
                options.append(Option(1 << bit, {name: F.lit(all_label)}))
            out.append(options)
        return out
    dim, region, segment = label_names(df, spec)
    by_region = [member(c, 10 * (i + 1), {dim: F.lit(c), region: F.col(c)}, True) for i, c in enumerate(regions)]
    if spec.keep_all_regions and regions:
        by_region.append(Option(2, {dim: F.lit(spec.all_regions), region: F.lit(spec.all_regions)}))
    by_segment = [member(c, 1000 * (j + 1), {segment: F.col(c)}, False) for j, c in enumerate(segments)]
    if segments:
        by_segment.append(Option(1, {segment: F.lit(spec.all_segments)}))
    return [by_region, by_segment]


def _entry(number: Column, options: list[Option] | tuple[Option, ...]) -> Column:
    """``struct<cell_id, labels>`` of a combination of options, null where the row does not take part."""
    labels = [v.cast("string").alias(k) for o in options for k, v in o.labels.items()]
    entry = F.struct(number.alias(CELL_ID), *labels)
    for condition in (c for o in options for c in o.conditions):
        entry = F.when(condition, entry)
    return entry


def _shared(regions: list[str], segments: list[str], spec: DimSpec) -> bool:
    return len(regions) > 1 or len(segments) > 1 or (spec.shared_labels and bool(regions) and bool(segments))


def label_names(df: DataFrame, spec: DimSpec) -> tuple[str, ...]:
    regions = [c for c in spec.regions if c in df.columns]
    segments = [c for c in spec.segments if c in df.columns]
    if _shared(regions, segments, spec):
        return (spec.region_dim_out, spec.region_out, spec.segment_out)
    own = [(c, out) for cols, out in ((regions, spec.region_out), (segments, spec.segment_out)) for c in cols[:1]]
    return tuple(out if spec.shared_labels else c for c, out in own)


def own_cells(df: DataFrame, spec: DimSpec) -> Column:
    """The cells a row belongs to: ``array<struct<cell_id, labels>>``."""
    entries = [_entry(F.lit(sum(o.number for o in chosen)), chosen) for chosen in cartesian(*axes(df, spec))]
    return F.filter(F.array(*entries), lambda x: x.isNotNull())


def roll_up(df: DataFrame, keys: list[str], spec: DimSpec, merge: dict[str, Callable[[str], Column]]) -> Cells:
    """The cells of rows that are aggregated per ``keys`` and members, one axis after the other.

    Every step makes an axis' roll-up and members from the rows of the step before, which are aggregated already:
    (region, segment) gives (region, all segments), and those two give (all regions, ...).  A parent is so made from
    its children and never from the rows of the table.  ``merge`` maps each measure to the aggregate that
    combines children (``sum`` for sums, ``bit_or`` for sets).  Where ``df`` is partitioned by some of ``keys``, no
    step moves a row.
    """
    names = label_names(df, spec)
    steps = axes(df, spec)
    out, done = df.withColumn(CELL_ID, F.lit(0)), []
    aggregates = [f(c).alias(c) for c, f in merge.items()]
    for i, options in enumerate(steps):
        later = list(dict.fromkeys(o.source for rest in steps[i + 1 :] for o in rest if o.source))
        new = list(options[0].labels) if options else []
        entries = F.filter(F.array(*[_entry(F.col(CELL_ID) + o.number, (o,)) for o in options]), lambda x: x.isNotNull())
        out = out.select(*keys, *done, *later, *merge, F.inline(entries))
        done += new
        out = out.groupBy(*keys, CELL_ID, *done, *later).agg(*aggregates)
    if not steps:
        out = out.groupBy(*keys, CELL_ID).agg(*aggregates)
    return Cells(out.select(*keys, CELL_ID, *names, *merge), names)


def carried(df: DataFrame, spec: DimSpec, carry: list[str]) -> list[str]:
    """``carry`` without the dimension columns, which the cells' labels replace."""
    dim_cols = set(spec.regions) | set(spec.segments) | set(label_names(df, spec))
    return [c for c in carry if c not in dim_cols]


def expand_cells(df: DataFrame, spec: DimSpec, carry: list[str]) -> Cells:
    """Explode each row into the cells it belongs to; keep ``carry`` columns."""
    names = label_names(df, spec)
    keep = carried(df, spec, carry)
    exploded = df.select(*keep, F.explode(own_cells(df, spec)).alias("__cell"))
    out = exploded.select(*keep, *[F.col(f"__cell.{c}").alias(c) for c in [CELL_ID, *names]])
    return Cells(out, names)


def expand_items(df: DataFrame, item_columns, items=None, type_col="product_type", value_col="product") -> DataFrame:
    """One row per (row, item level): ``product_type`` = level name, ``product`` = value.

    ``items`` (optional) keeps only the listed values at every level.
    """
    item_columns = list(item_columns)
    if len(item_columns) == 1:
        c = item_columns[0]
        out = df.withColumn(value_col, F.col(c).cast("string")).withColumn(type_col, F.lit(c))
    else:
        arr = F.array(*[F.struct(F.lit(c).alias("t"), F.col(c).cast("string").alias("v")) for c in item_columns])
        out = df.withColumn("__item", F.explode(arr))
        out = out.withColumn(type_col, F.col("__item.t")).withColumn(value_col, F.col("__item.v")).drop("__item")
    out = out.where(F.col(value_col).isNotNull())
    if items is not None:
        out = out.where(F.col(value_col).isin([str(i) for i in items]))
    return out
