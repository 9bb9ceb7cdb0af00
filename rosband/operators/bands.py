"""Quantile edges per cell and date, period band prices, band assignment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from math import prod

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosband.functions.bands import band_of, percentile_array
from rosband.operators.joins import attach, materialize
from rosband.operators.rollup import CELL_ID, Option, axes, expand_cells, label_names
from rosband.schema import DimSpec

EDGES = "edges"


#: Price buckets per doubling of the price.
BUCKETS = 64


def price_bucket(price: Column) -> Column:
    """A bucket number that never falls when the price rises (relative width 2^(1/64) away from 0)."""
    magnitude = F.floor(F.log2(F.abs(price)) * BUCKETS)
    # log2 of a double lies between -1,075 and 1,024, so shifted magnitudes are positive
    shifted = magnitude + 1100 * BUCKETS
    return F.when(price == 0, F.lit(0).cast("long")).when(price > 0, shifted).otherwise(-shifted)


def price_histogram(rows: DataFrame, keys: Sequence[str], price: str = "price", count: Column | None = None) -> DataFrame:
    """``keys, price, __n``: rows per price; ``count`` sums rows that were counted before."""
    n = F.count(F.lit(1)) if count is None else F.sum(count)
    return rows.where(F.col(price).isNotNull()).groupBy(*keys, price).agg(n.alias("__n"))


def counted_prices(rows: DataFrame, keys: Sequence[str], price: str = "price", repeats: float = 2.0) -> DataFrame:
    """``keys, price, __n``: rows per price where that is worth a pass, else every row with a count of one.

    Whether a price (per ``keys``) has ``repeats`` rows on average is measured on all rows with an approximate
    distinct count.  The measurement chooses the plan only; quantiles of the result are the same either way.
    """
    rows = rows.where(F.col(price).isNotNull()).select(*keys, price)
    measured = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*keys, price)).alias("d")).first()
    if measured["n"] >= repeats * measured["d"]:
        return materialize(price_histogram(rows, keys, price))
    return rows.withColumn("__n", F.lit(1).cast("long"))


def edges_from_histogram(hist: DataFrame, keys: Sequence[str], quantiles: Sequence[float], price: str = "price") -> DataFrame:
    """Exact quantiles (linear interpolation at q*(n-1)) of ``price`` per key, by selecting ranks.

    ``hist`` (keys, price, __n) is read twice and may hold a price several times, so it can be a plan that expands
    rows as it reads them.  Prices fall into buckets; the bucket totals (a few hundred rows per key at most) show in
    which bucket each wanted rank lies, these buckets are written, and only their rows are moved and ordered
    by price.  No task ever holds the prices of a cell: the largest unit of work is one bucket.
    """
    keys = list(keys)
    binned = hist.withColumn("__bucket", price_bucket(F.col(price)))
    totals = binned.groupBy(*keys, "__bucket").agg(F.sum("__n").alias("__in"))
    wanted = materialize(_wanted_buckets(totals, keys, quantiles))
    return _picked_edges(binned.join(wanted, [*keys, "__bucket"]), keys, quantiles, price)


def edges_of_cells(
    hist: DataFrame, spec: DimSpec, members: Sequence[str], item_keys: Sequence[str], quantiles: Sequence[float], price: str = "price"
) -> DataFrame:
    """``edges_from_histogram`` of every cell of rows (``item_keys``, ``members``, price, ``__n``) that are not expanded.

    Bucket totals are made per combination of members, and a cell's from these; then each combination is told which of its
    cells want a bucket.  A row is looked up once, and repeated only for the cells that want its bucket.
    """
    item_keys, own = list(item_keys), [f"__own{i}" for i in range(len(members))]
    binned = hist.withColumn("__bucket", price_bucket(F.col(price)))
    parts = materialize(binned.groupBy(*item_keys, *members, "__bucket").agg(F.sum("__n").alias("__in")))
    copied = parts.withColumns({o: F.col(m) for o, m in zip(own, members, strict=True)}) if own else parts
    cells = expand_cells(copied, spec, [*item_keys, "__bucket", "__in", *own, *members])
    keys = [*item_keys, *cells.keys]
    totals = cells.df.groupBy(*keys, "__bucket").agg(F.sum("__in").alias("__in"))
    wanted = materialize(_wanted_buckets(totals, keys, quantiles))
    cell = F.struct(*cells.keys, "__before", "__all", "__ranks")
    wants = cells.df.drop("__in").join(wanted, [*keys, "__bucket"]).groupBy(*item_keys, *own, "__bucket")
    wants = materialize(wants.agg(F.collect_list(cell).alias("__cells")))
    renamed = wants.select(*[F.col(c).alias(f"__w_{c}") for c in [*item_keys, "__bucket"]], *own, "__cells")
    here = [F.col(c) == F.col(f"__w_{c}") for c in [*item_keys, "__bucket"]]
    here += [F.col(m).eqNullSafe(F.col(o)) for m, o in zip(members, own, strict=True)]
    found = binned.join(renamed, reduce(Column.__and__, here))
    found = found.select(*item_keys, "__bucket", price, "__n", F.inline("__cells"))
    return _picked_edges(found, keys, quantiles, price)


def _wanted_buckets(totals: DataFrame, keys: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """The buckets that hold a wanted rank: ``keys, __bucket, __before`` (rows below), ``__all`` (rows), ``__ranks``."""
    cell = Window.partitionBy(*keys)
    upto = cell.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__before", F.coalesce(F.sum("__in").over(upto), F.lit(0))).withColumn("__all", F.sum("__in").over(cell))
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in _rank_places(quantiles) for f in (F.floor, F.ceil)]))
    here = F.filter(ranks, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__in")))
    return totals.withColumn("__ranks", here).where(F.size("__ranks") > 0).drop("__in")


def _rank_places(quantiles: Sequence[float]) -> list[Column]:
    return [F.lit(float(q)) * (F.col("__all") - 1) for q in quantiles]


def _picked_edges(found: DataFrame, keys: Sequence[str], quantiles: Sequence[float], price: str) -> DataFrame:
    """Edges from the rows of the wanted buckets."""
    places = _rank_places(quantiles)
    inside = Window.partitionBy(*keys, "__bucket").orderBy(price).rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("__end", F.col("__before") + F.sum("__n").over(inside))
    hit = F.filter("__ranks", lambda r: (r >= F.col("__end") - F.col("__n")) & (r < F.col("__end")))
    found = found.select(*keys, "__all", F.col(price).alias("__p"), F.explode(hit).alias("__rank"))
    picked = found.groupBy(*keys).agg(
        F.first("__all").alias("__all"), F.map_from_entries(F.collect_list(F.struct("__rank", "__p"))).alias("__at")
    )

    def edge(place: Column) -> Column:
        low = F.element_at("__at", F.floor(place).cast("long"))
        high = F.element_at("__at", F.ceil(place).cast("long"))
        return low + (high - low) * (place - F.floor(place))

    return picked.select(*keys, F.array(*[edge(p) for p in places]).alias(EDGES))


def quantile_edges(rows: DataFrame, keys: Sequence[str], quantiles: Sequence[float], price: str = "price") -> DataFrame:
    """Exact quantiles of ``price`` per key: ``edges: array<double>`` in the order of ``quantiles``."""
    return edges_from_histogram(materialize(price_histogram(rows, keys, price)), keys, quantiles, price)


def edges_wide(edges: DataFrame, keys: Sequence[str], quantiles: Sequence[float], prefix: str = "q") -> DataFrame:
    """One column per quantile (``q20`` ... ``q100``): the unstacked layout."""
    cols = [F.col(EDGES).getItem(i).alias(f"{prefix}{round(q * 100):d}") for i, q in enumerate(quantiles)]
    return edges.select(*keys, *cols)


def edges_long(edges: DataFrame, keys: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """Long layout: keys, ``percentile``, ``edge``."""
    pairs = F.arrays_zip(percentile_array(quantiles).alias("percentile"), F.col(EDGES).alias("edge"))
    return edges.select(*keys, F.inline(pairs))


def band_prices(edges: DataFrame, keys: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """Unweighted mean over dates of every edge, melted to (percentile, percentile_price).

    ``keys`` are the cell keys without the date.
    """
    means = [F.avg(F.col(EDGES).getItem(i)).alias(f"__m{i}") for i in range(len(quantiles))]
    agg = edges.groupBy(*keys).agg(*means)
    pairs = F.array(
        *[
            F.struct(F.lit(float(q)).alias("percentile"), F.col(f"__m{i}").alias("percentile_price"))
            for i, q in enumerate(quantiles)
        ]
    )
    return agg.select(*keys, F.inline(pairs))


def _dense(df: DataFrame, keys: Sequence[str], code: str, value: str, name: str) -> DataFrame:
    """Per ``keys`` the array that has each row's ``value`` at the place ``code`` (null at places without a row)."""
    before = F.lag(code).over(Window.partitionBy(*keys).orderBy(code))
    holes = F.col(code) - F.coalesce(before, F.lit(-1)) - 1
    piece = F.concat(F.array_repeat(F.lit(None).cast(df.schema[value].dataType), holes.cast("int")), F.array(value))
    pieces = F.array_sort(F.collect_list(F.struct(code, "__piece")))
    out = df.withColumn("__piece", piece).groupBy(*keys)
    return out.agg(F.flatten(F.transform(pieces, lambda x: x["__piece"])).alias(name))


def numbered_members(edges: DataFrame, steps: Sequence[Sequence[Option]], axis: int) -> DataFrame:
    """``option, label, code``: the members of an axis that have edges, numbered from 1 (0 is the roll-up).

    One row per member of a dimension, so the window that numbers them is bounded by the dimension.
    """
    number, label = _part_of(steps, axis), list(steps[axis][0].labels)[-1]
    found = edges.select(number.alias("option"), F.col(label).alias("label"))
    found = found.where(F.col("option").isin([i for i, o in enumerate(steps[axis]) if o.source])).distinct()
    return materialize(found.withColumn("code", F.row_number().over(Window.orderBy("option", "label"))))


def _part_of(steps: Sequence[Sequence[Option]], axis: int) -> Column:
    """Which option of an axis a cell id stands for."""
    out = F.lit(None).cast("int")
    for chosen in product(*[list(enumerate(options)) for options in steps]):
        out = F.when(F.col(CELL_ID) == sum(o.number for _, o in chosen), F.lit(chosen[axis][0])).otherwise(out)
    return out


@dataclass(frozen=True)
class Axis:
    """Number of places of a dimension (0: the roll-up) and the column of a row with its place, per option (None: 0)."""

    size: int
    columns: tuple[str | None, ...]


def member_places(rows: DataFrame, spec: DimSpec, cells: DataFrame) -> tuple[DataFrame, DataFrame, list[Axis]]:
    """``rows`` with the places of their members, ``cells`` with the place of theirs per axis (``__place<axis>``), the axes.

    ``cells`` (cell id and labels) says which members there are; a row's place is null where its member is not among them.
    """
    steps, found = axes(rows, spec), []
    places = cells
    for axis, options in enumerate(steps):
        label, at = list(options[0].labels)[-1], f"__place{axis}"
        members = numbered_members(cells, steps, axis)
        coded = members.select(F.col("option").alias("__option"), F.col("label").alias("__label"), F.col("code").alias(at))
        places = places.withColumn("__option", _part_of(steps, axis)).withColumn("__label", F.col(label))
        rolled = [i for i, o in enumerate(options) if not o.source]
        places = places.join(coded, ["__option", "__label"], "left").withColumn(
            at, F.when(F.col("__option").isin(rolled), F.lit(0)).otherwise(F.col(at))
        ).drop("__option", "__label")
        columns: list[str | None] = []
        for i, o in enumerate(options):
            columns.append(f"__code{axis}_{i}" if o.source else None)
            if o.source:
                own = members.where(F.col("option") == i).select(F.col("label").alias("__label"), F.col("code").alias(columns[-1]))
                rows = attach(rows.withColumn("__label", F.col(o.source).cast("string")), own, ["__label"], "left").drop("__label")
        found.append(Axis(members.count() + 1, tuple(columns)))
    return rows, places, found


def cell_number(places: Sequence[Column], found: Sequence[Axis]) -> Column:
    """The number of a cell from its places, below the product of the axes' sizes."""
    out = F.lit(0)
    for place, axis in zip(places, found, strict=True):
        out = out * axis.size + place
    return out


@dataclass(frozen=True)
class Placed:
    """Rows that carry the edges of their date and item, and how each of their cells finds its own."""

    rows: DataFrame
    cells: DataFrame  # cell id and labels with their ``__cell`` number
    n_cells: int
    chosen: list[tuple[Column, Column, tuple[Option, ...]]]  # a row's cells: number, edges (null: none) and options

    def assigned(self, keep: Sequence[str], quantiles: Sequence[float], names: Sequence[str], price: str) -> DataFrame:
        """One row per row and cell with ``percentile``, the cell's band."""
        entries = []
        for _, found, options in self.chosen:
            labels = {k: v.cast("string") for o in options for k, v in o.labels.items()}
            entry = F.struct(
                F.lit(sum(o.number for o in options)).alias(CELL_ID), *[labels[n].alias(n) for n in names],
                band_of(F.col(price), found, quantiles).alias("percentile"),
            )
            entries.append(F.when(found.isNotNull(), entry))
        return self.rows.select(*keep, F.inline(F.filter(F.array(*entries), lambda x: x.isNotNull())))

    def coded(self, keep: Sequence[str], quantiles: Sequence[float], price: str) -> DataFrame:
        """``keep`` and, in ``__bits``, the number of the band of each of a row's cells (see ``band_bits``; null: no edges).

        Written, it spares those who read it the join with the edges and the looking up."""
        bits, width = [], len(quantiles) + 2
        for number, found, _ in self.chosen:
            band = band_of(F.col(price), found, [float(i) for i in range(len(quantiles))])
            band = F.coalesce(band.cast("int"), F.lit(len(quantiles)))
            bits.append(F.when(found.isNotNull(), number * width + band))
        return self.rows.select(*keep, F.array(*bits).alias("__bits"))

    def expanded(self, coded: DataFrame, keep: Sequence[str], quantiles: Sequence[float], names: Sequence[str]) -> DataFrame:
        """``assigned`` from ``coded`` rows, which keep the columns of the members."""
        labels_of = F.array(*[F.lit(q).cast("double") for q in [*quantiles, None]])
        entries = []
        for i, (_, _, options) in enumerate(self.chosen):
            labels = {k: v.cast("string") for o in options for k, v in o.labels.items()}
            bit = F.get("__bits", F.lit(i))
            entry = F.struct(
                F.lit(sum(o.number for o in options)).alias(CELL_ID), *[labels[n].alias(n) for n in names],
                F.get(labels_of, bit % (len(quantiles) + 2)).alias("percentile"),
            )
            entries.append(F.when(bit.isNotNull(), entry))
        return coded.select(*keep, F.inline(F.array(*entries))).where(F.col(CELL_ID).isNotNull())

    def bits(self, quantiles: Sequence[float]) -> list[Column]:
        """Numbers of a coded row's bands and, above the bands of each cell, of its cells (see ``band_bits``)."""
        width = len(quantiles) + 2
        bands = [F.get("__bits", F.lit(i)) for i in range(len(self.chosen))]
        return [b for bit in bands for b in (bit, bit - bit % width + (len(quantiles) + 1))]

    def band_bits(self, quantiles: Sequence[float], names: Sequence[str], bit: str) -> tuple[DataFrame, DataFrame]:
        """``bit`` of every band (cell, ``percentile``; null above every edge) and of every cell over its bands."""
        width = len(quantiles) + 2
        bands = F.array(*[
            F.struct((F.col("__cell") * width + i).alias(bit), F.lit(q).cast("double").alias("percentile"))
            for i, q in enumerate([*quantiles, None])
        ])
        whole = self.cells.select((F.col("__cell") * width + len(quantiles) + 1).alias(bit), CELL_ID, *names)
        return self.cells.select(CELL_ID, *names, F.inline(bands)), whole


def place_edges(
    rows: DataFrame, spec: DimSpec, edges: DataFrame, item_keys: Sequence[str]
) -> Placed:
    """``edges`` has a row per date, item and cell.  Members are numbered per dimension; the edges of a date and item are
    gathered in nested arrays whose places are these numbers (0: the roll-up) and joined to the rows before these are
    expanded: however the planner runs the join, a row is moved at most once.  A row looks up each of its cells
    by place, in constant time whatever the number of cells.
    """
    names, steps = label_names(rows, spec), axes(rows, spec)
    rows, places, found = member_places(rows, spec, edges)
    at = [f"__place{i}" for i in range(len(steps))]
    cells = places.select(CELL_ID, *names, cell_number([F.col(c) for c in at], found).alias("__cell")).distinct()
    value = EDGES
    for axis in reversed(range(len(steps))):
        outer = [*item_keys, *at[:axis]]
        places = _dense(places.select(*outer, f"__place{axis}", value), outer, f"__place{axis}", value, f"__edges{axis}")
        value = f"__edges{axis}"
    joined = attach(rows, materialize(places.select(*item_keys, F.col(value).alias("__edges"))), item_keys)
    chosen = []
    for options in product(*[list(zip(o, a.columns, strict=True)) for o, a in zip(steps, found, strict=True)]):
        own = [F.col(c) if c else F.lit(0) for _, c in options]
        looked_up = F.col("__edges")
        for place in own:
            looked_up = F.get(looked_up, place)
        chosen.append((cell_number(own, found), looked_up, tuple(o for o, _ in options)))
    return Placed(joined, materialize(cells), prod(a.size for a in found), chosen)


def assign_bands(
    rows: DataFrame,
    spec: DimSpec,
    edges: DataFrame,
    item_keys: Sequence[str],
    keep: Sequence[str],
    quantiles: Sequence[float],
    price: str = "price",
) -> DataFrame:
    """One row per row and cell: ``keep``, the cell's columns and ``percentile``, the cell's band of the same date.

    The band is the first quantile whose edge is >= the price; see ``place_edges``.
    """
    return place_edges(rows, spec, edges, item_keys).assigned(keep, quantiles, label_names(rows, spec), price)
