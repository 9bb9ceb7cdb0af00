"""Reading the extract straight from a relational source over JDBC.

The analysed job sends one aggregate query to the database.  With Spark the
same query text can be sent with the ``query`` option (the database filters
and aggregates), or the view can be read as ``dbtable`` with a numeric
``partitionColumn`` so that many executors read disjoint ranges in parallel
and Spark performs the aggregation.  Only option building is local; nothing
here opens a connection until ``load()`` runs on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    query: str | None = None,
    dbtable: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetchsize: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    if (query is None) == (dbtable is None):
        raise ValueError("give exactly one of query / dbtable")
    if query is not None and partition_column is not None:
        raise ValueError("partitionColumn needs dbtable (Spark rejects it with query)")
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if query is not None:
        opts["query"] = query
    else:
        opts["dbtable"] = dbtable
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()
