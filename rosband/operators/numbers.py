"""Dense numbers for the values of a column, exact sets of numbers that merge, and exact counts of members per cell.

Distinct members of many overlapping cells are counted the other way round: a member's rows meet in one task and are joined to
the set of cells it is in (a few 64-bit words, ``bit_or``); equal sets are counted, and only these counts are taken apart
into cells.  A row is moved once and never repeated per cell, and a task holds one entry per member, whatever the number of
cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosband.operators.joins import attach, materialize

WORD, BITS = "__word", "__bits"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def ordinal(df: DataFrame, order_by: str, name: str = "position") -> DataFrame:
    """Number the rows 1..n in ascending ``order_by`` order without a single-task window."""
    parts = max(1, df.sparkSession.sparkContext.defaultParallelism)
    ranged = df.repartitionByRange(parts, F.col(order_by).asc_nulls_last()).sortWithinPartitions(order_by)
    # a monotonic id is the partition's number and, in its low 33 bits, the row's place in the partition
    ranged = ranged.withColumn("__mid", F.monotonically_increasing_id())
    ranged = ranged.withColumn("__pid", F.shiftright("__mid", 33)).withColumn("__local", F.col("__mid") - F.shiftleft(F.col("__pid"), 33))
    ranged = materialize(ranged.drop("__mid"))
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: a running sum over this tiny table gives each partition's offset
    offsets = sizes.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    ).fillna(0, ["__off"])
    out = ranged.join(offsets, "__pid")
    return out.select(
        (F.col("__off") + F.col("__local") + F.lit(1)).cast("long").alias(name),
        *[c for c in df.columns],
    )


def set_words(df: DataFrame, member: str) -> DataFrame:
    """Add the place of ``member`` in a bitmap: the number of its 64-bit word (``__word``) and its bit (``__bits``).

    A set is kept as one row per word, ``bit_or`` merges sets word by word and ``set_size`` counts them: exact, in
    hash aggregates, and of at most as many rows as members.  Integers are their own numbers, other values are numbered
    densely first.
    """
    number = member
    if not isinstance(df.schema[member].dataType, _INTEGRAL):
        number = "__number"
        values = ordinal(df.select(member).where(F.col(member).isNotNull()).distinct(), member, number)
        df = attach(df, materialize(values), [member])
    n = F.col(number).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), n.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return df.withColumns({WORD: F.shiftright(n, 6), BITS: bit})


def set_size(bits: str = BITS) -> Column:
    """Members of a set, over its words."""
    return F.sum(F.bit_count(bits)).cast("long")


#: 64-bit words of a piece of the cells' bits; rows of one task where they are gathered per member.
WORDS, ROWS_PER_TASK = 4, 500_000
PIECE = "__piece"
_PIECE_BITS = 64 * WORDS


def _masks(n_bits: int) -> list[str]:
    return [f"__mask{w}" for w in range(max(1, min(WORDS, -(-n_bits // 64))))]


def cell_masks(rows: DataFrame, keep: Sequence[str], bits: Sequence[Column], n_bits: int) -> DataFrame:
    """``keep`` and, in words of 64 bits, which of ``n_bits`` cells a row belongs to; ``bits`` are its cells' numbers (or null).

    Rows are not repeated per cell.  More than ``64 * WORDS`` cells are cut in pieces: the different rows (``keep`` and
    cells) are then repeated per piece in which they have a cell.
    """
    keep, own = list(keep), [f"__bit{i}" for i in range(len(bits))]
    out = rows.select(*keep, *[b.cast("int").alias(c) for b, c in zip(bits, own, strict=True)])
    piece = F.lit(0)
    if n_bits > _PIECE_BITS:
        places = F.array_compact(F.array(*[F.floor(F.col(c) / _PIECE_BITS).cast("int") for c in own]))
        out = out.distinct().select(*keep, *own, F.explode(F.array_distinct(places)).alias(PIECE))
        piece = F.col(PIECE)

    def mask(word: int) -> Column:
        low = piece * _PIECE_BITS + 64 * word
        inside = [
            F.when((F.col(c) >= low) & (F.col(c) < low + 64), F.call_function("shiftleft", F.lit(1).cast("long"), F.col(c) - low))
            for c in own
        ]
        return reduce(Column.bitwiseOR, [F.coalesce(x, F.lit(0).cast("long")) for x in inside])

    return out.select(*keep, piece.alias(PIECE), *[mask(w).alias(m) for w, m in enumerate(_masks(n_bits))])


def tasks_for(n_rows: int, spark: SparkSession) -> int:
    """Partitions of rows that a task gathers in memory: their number follows the rows, a task's share does not."""
    return max(spark.sparkContext.defaultParallelism, -(-n_rows // ROWS_PER_TASK))


def gathered(masked: DataFrame, keys: Sequence[str], n_bits: int) -> DataFrame:
    """The cells in which a member (last of ``keys``) occurs: the union over its rows."""
    return masked.groupBy(*keys, PIECE).agg(*[F.bit_or(m).alias(m) for m in _masks(n_bits)])


def counted_masks(gathered_rows: DataFrame, keys: Sequence[str], n_bits: int) -> DataFrame:
    """Members (``__members``) per ``keys`` and set of cells; members that are in the same cells are one row."""
    return gathered_rows.groupBy(*keys, PIECE, *_masks(n_bits)).agg(F.count(F.lit(1)).alias("__members"))


def members_per_cell(counted: DataFrame, keys: Sequence[str], n_bits: int, bit: str, name: str) -> DataFrame:
    """Distinct members per ``keys`` and cell number ``bit``."""
    def numbers(word: int, mask: str) -> Column:
        inside = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("getbit", F.col(mask), i) == 1)
        return F.transform(inside, lambda i: F.col(PIECE) * _PIECE_BITS + F.lit(64 * word) + i)

    cells = F.concat(*[numbers(w, m) for w, m in enumerate(_masks(n_bits))])
    out = counted.select(*keys, F.explode(cells).alias(bit), "__members")
    return out.groupBy(*keys, bit).agg(F.sum("__members").alias(name))
