"""Intermediate tables and attaching group statistics to row-level data.

Group statistics (means, deviations, quantile edges, totals) are computed with partial
aggregation, written to the shared folder and joined back to the rows.  The written table is
Parquet, so Spark knows its size: the planner and adaptive execution broadcast it below the
session's threshold and otherwise run a shuffle join whose hot partitions they split.  No hint
is given and no size is guessed here.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from rosband.session import checkpoint_dir


class Datasets:
    """The intermediate tables of one job; ``close`` deletes them.

    ``with datasets.active():`` makes ``materialize`` register its tables here.  Close it when the job's
    results have been consumed: lazy frames that read the tables fail afterwards.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    @contextmanager
    def active(self) -> Iterator[Datasets]:
        token = _OWNER.set(self)
        try:
            yield self
        finally:
            _OWNER.reset(token)

    def path(self, prefix: str = "rosband") -> str:
        """A fresh path in the shared folder that belongs to this job."""
        path = f"{checkpoint_dir(self.spark)}/{prefix}-{uuid.uuid4().hex}"
        self.paths.append(path)
        return path

    def close(self) -> int:
        """Delete every table of the job; returns how many there were."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        n = 0
        while self.paths:
            p = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            n += bool(p.getFileSystem(conf).delete(p, True))
        return n


_OWNER: ContextVar[Datasets | None] = ContextVar("rosband_datasets", default=None)


def materialize(df: DataFrame, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write an intermediate as Parquet to the shared folder and read it back with its own schema.

    This cuts the lineage like ``checkpoint()`` but in a single job (``checkpoint(eager=True)`` computes
    its input twice), and the data survives the loss of executors.  With ``partition_by`` the dataset is
    laid out in directories by those columns, so that filters on them prune whole directories.  The table
    belongs to the active ``Datasets``; without one it stays until the folder is cleaned.
    """
    spark = df.sparkSession
    owner = _OWNER.get() or Datasets(spark)
    path = owner.path()
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def attach(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join group statistics to row-level data; the planner chooses the strategy by size."""
    return big.join(small, list(on), how)
