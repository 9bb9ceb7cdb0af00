"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosband.operators.joins import materialize

#: What separates words in the word-based operators: space and U+0009 to U+000D.
WORD_SPLIT = r"[ \t-\r]+"


def written(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder (``spark.checkpoint.dir``) and read it back: cuts the lineage.

    The table belongs to the active ``Datasets`` handle, which deletes it when closed."""
    return materialize(df)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (bound as a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of ``text``."""
    return F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")
