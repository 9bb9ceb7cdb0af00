"""Operator 9: mixing sources to target weights by hierarchical budgeting (DataFrame operations only).

The corpus is a tree of domain, language and source.  A leaf can give its tokens ``epochs`` times; an
inner node what its children can.  From the root down each node's budget goes to its children in
proportion to their weights; what a child cannot give is dealt to its siblings in proportion to theirs,
and only what all of them cannot give has been left with their ancestors' siblings (a node is never asked
for more than its children can give).  With children sorted by capacity per weight this is one cumulative
sum over the children of a node.

A leaf with budget ``q`` and ``a`` tokens is read whole ``q // a`` times; the rest is the prefix, by running
sum of tokens, of the next epoch's order: documents by MD5 of seed, epoch and doc_id.  The order is cut
into 4,096 buckets by the first three hex digits, whose totals place every bucket before, at or behind
the end of the prefix; only the one bucket per leaf that holds the end is sorted.  No leaf is ever in one
task, however large its source.

Tokens are words between space and U+0009 to U+000D.  Domains: the test documents have none, so
``domain_of_source`` deals sources to four of them; it is a parameter.  A tree is a mapping of level names to columns
of the documents; levels need a value in every row (a null node joins nothing, its rows are not selected).

Defined cases: null lang, source or doc_id count as the empty string in tree and order; null or empty
texts have no tokens and cost nothing; documents without tokens are in every prefix that ends behind
them; rows with equal doc_id are ordered by text, rows that also share the text are taken together; an empty table gives an
empty result; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosband.llm.common import WORD_SPLIT, text_or_empty, written

EPOCHS = 2
BUDGET_SHARE = 0.8
SEED = "mix-1"
_BUCKET_DIGITS = 3


def domain_of_source() -> Column:
    digit = F.substring(F.md5(F.coalesce("source", F.lit(""))), 1, 1)
    return F.concat(F.lit("domain"), F.pmod(F.ascii(digit), F.lit(4)).cast("string"))


#: Levels of the tree from the root down: name and column.
TREE: dict[str, Callable[[], Column]] = {
    "domain": domain_of_source,
    "language": lambda: F.coalesce(F.col("lang"), F.lit("")),
    "leaf_source": lambda: F.coalesce(F.col("source"), F.lit("")),
}


#: Target weights of the registered query and the pipeline by level and node; nodes that are not named weigh 1.
WEIGHTS: dict[str, dict[str, float]] = {
    "domain": {"domain0": 3.0, "domain1": 2.0, "domain3": 0.5},
    "language": {"en": 4.0, "de": 2.0, "": 0.25},
    "leaf_source": {"": 0.5},
}


def n_tokens(text: Column) -> Column:
    """Words of a text: runs of separators become one space, spaces at the ends go, the rest is counted."""
    flat = F.btrim(F.regexp_replace(text, WORD_SPLIT, " "))
    return F.when(flat == "", F.lit(0)).otherwise(
        F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1
    ).cast("long")


def weight_of(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    """Weight of a node by its name; 1 where none is given."""
    own = weights.get(level, {})
    if not own:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for kv in own.items() for x in kv])
    return F.coalesce(F.element_at(table, F.col(level)), F.lit(1.0)).cast("double")


def share_out(children: DataFrame, parents: list[str]) -> DataFrame:
    """Add ``budget`` to rows with ``capacity``, ``weight`` and their parent's ``given``.

    Children sorted by capacity per weight: a child is filled when its capacity is at most its weight's part of
    what the children before it have left over; the others share the rest by weight."""
    order = Window.partitionBy(*parents).orderBy((F.col("capacity") / F.col("weight")).asc(), *children.columns[: len(parents) + 1])
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    full = F.col("capacity") <= F.col("level") * F.col("weight")
    return (
        children.withColumn("level", level)
        .withColumn("full", full)
        .withColumn("rest_level", F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy(*parents)))
        .withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(F.col("rest_level") * F.col("weight")))
        .drop("level", "full", "rest_level")
    )


def budgets(leaves: DataFrame, levels: list[str], total: Column, epochs: int, weights: Mapping) -> DataFrame:
    """``quota`` tokens for every leaf.  ``leaves``: one row per leaf with ``tokens``; ``total``: the budget as an
    aggregate of ``leaves``."""
    capacity = leaves.withColumn("capacity", (F.col("tokens") * epochs).cast("double"))
    parents = capacity.groupBy().agg(total.cast("double").alias("asked"), F.sum("capacity").alias("most"))
    parents = parents.select(F.lit(0).alias("root"), F.least("asked", "most").alias("given"))
    above = ["root"]
    for k, level in enumerate(levels):
        at = levels[: k + 1]
        children = capacity.groupBy(*at).agg(F.sum("capacity").alias("capacity")).withColumn("root", F.lit(0))
        children = children.withColumn("weight", weight_of(level, weights)).join(parents, above)
        children = children.select("root", *at, "capacity", "weight", "given")
        done = share_out(children, above)
        parents = done.select("root", *at, F.col("budget").alias("given"))
        above = ["root", *at]
    return leaves.join(parents.drop("root"), levels).withColumn("quota", F.floor("given").cast("long"))


def select(
    docs: DataFrame,
    tree: Mapping[str, Callable[[], Column]] = TREE,
    weights: Mapping[str, Mapping[str, float]] | None = None,
    budget_share: float = BUDGET_SHARE,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Per document: doc_id, text_hash, the levels, ``rows`` (equal rows), ``n_tokens`` of a row, ``copies`` (epochs that
    take it, 0 or more).  Equal rows are taken together.

    The budget is ``budget_share`` of the corpus's tokens."""
    levels = list(tree)
    text = text_or_empty()
    thin = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(text).alias("text_hash"),
        *[make().alias(name) for name, make in tree.items()],
        n_tokens(text).alias("own_tokens"),
    )
    thin = thin.groupBy("doc_id", "text_hash", *levels).agg(F.first("own_tokens").alias("own_tokens"), F.count("*").alias("rows"))
    thin = written(thin.withColumn("n_tokens", F.col("own_tokens") * F.col("rows")))
    leaves = written(thin.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")))
    total = F.floor(F.sum("tokens") * F.lit(budget_share))
    quota = budgets(leaves, levels, total, epochs, weights or {})
    whole = F.when(F.col("tokens") > 0, F.least(F.lit(epochs).cast("long"), F.expr("quota div tokens"))).otherwise(F.lit(epochs).cast("long"))
    plan = quota.withColumn("whole", whole.cast("long")).withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens"))
    plan = written(plan.select(*levels, "whole", "rest"))

    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed = (
        thin.join(plan, levels)
        .withColumn("place", order)
        .withColumn("bucket", F.substring("place", 1, _BUCKET_DIGITS))
    )
    running = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        placed.groupBy(*levels, "bucket")
        .agg(F.sum("n_tokens").alias("bucket_tokens"))
        .withColumn("before", F.coalesce(F.sum("bucket_tokens").over(running), F.lit(0).cast("long")))
    )
    placed = placed.join(ends, [*levels, "bucket"])
    open_end = F.col("whole") < epochs
    inside = open_end & (F.col("before") + F.col("bucket_tokens") <= F.col("rest"))
    cut = open_end & (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("bucket_tokens") > F.col("rest"))
    columns = ["doc_id", "text_hash", *levels, "rows", F.col("own_tokens").alias("n_tokens")]
    upto = F.sum("n_tokens").over(
        Window.partitionBy(*levels, "bucket").orderBy("place", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    )
    ended = placed.where(cut).withColumn("taken", (F.col("before") + upto <= F.col("rest")).cast("long"))
    others = placed.where(~cut).withColumn("taken", inside.cast("long"))
    both = others.unionByName(ended)
    return both.select(*columns, (F.col("whole") + F.col("taken")).alias("copies"))


def mix(docs: DataFrame, tree: Mapping[str, Callable[[], Column]] = TREE, epochs: int = EPOCHS, **parameters) -> DataFrame:
    """The rows of ``docs`` that are selected, each as often as epochs take it."""
    taken = select(docs, tree, epochs=epochs, **parameters).where("copies > 0").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__llm_id"),
        F.col("text_hash").alias("__llm_hash"),
        *[F.col(x).alias(f"__llm_{x}") for x in tree],
        F.col("copies").alias("__llm_copies"),
    )
    keyed = docs.withColumns({
        "__llm_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        "__llm_hash": F.md5(text_or_empty()),
        **{f"__llm_{x}": make() for x, make in tree.items()},
    })
    rows = keyed.join(taken, ["__llm_id", "__llm_hash", *[f"__llm_{x}" for x in tree]])
    return rows.withColumn("__llm_epoch", F.explode(F.sequence(F.lit(1), F.col("__llm_copies").cast("int")))).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its place in the tree, its tokens and how many epochs take it."""
    rows = select(docs, weights=WEIGHTS).withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return rows.select("doc_id", *TREE, "n_tokens", "copies")
