"""Product selections: an IN predicate, or a rule table applied as a left-semi join.

The semi join is an equi-join on the product with the nullable rules as a further condition,
so the planner may broadcast the rules by their size or shuffle both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SELECTION_SCHEMA = T.StructType(
    [
        T.StructField("sel_product", T.StringType(), False),
        T.StructField("sel_size", T.StringType(), True),
        T.StructField("sel_format", T.StringType(), True),
    ]
)


def selection_table(spark: SparkSession, rules: Sequence[tuple]) -> DataFrame:
    """Rules as (product,), (product, size) or (product, size, format); missing or
    None size/format means "any"."""
    rows = [tuple(list(r) + [None] * (3 - len(r))) for r in rules]
    return spark.createDataFrame(rows, SELECTION_SCHEMA)


def select_products(df: DataFrame, products: Sequence[str], product: str = "product") -> DataFrame:
    """Keep rows whose product is in the list (an IN predicate, pushed down)."""
    return df.where(F.col(product).isin(list(products)))


def select_products_multi(
    df: DataFrame,
    selection: DataFrame,
    product: str = "product",
    size: str = "size",
    fmt: str = "format",
    case_insensitive: bool = True,
) -> DataFrame:
    """Keep rows matching any rule: product AND (size any or equal) AND (format any or equal).

    The source compares strings case-insensitively, so both sides are lower-cased
    unless ``case_insensitive`` is False.
    """
    norm = (lambda c: F.lower(c)) if case_insensitive else (lambda c: c)
    sel = selection
    cond = (
        (norm(df[product]) == norm(sel["sel_product"]))
        & (sel["sel_size"].isNull() | (norm(df[size]) == norm(sel["sel_size"])))
        & (sel["sel_format"].isNull() | (norm(df[fmt]) == norm(sel["sel_format"])))
    )
    return df.join(sel, cond, "left_semi")
