"""Report assembly: result tables plus drop-down lists.

The lists sheet of the analysed report holds independent distinct lists side by
side (region, segment, product [, date]), padded with blanks.  Here each list
is sorted ascending (first-appearance order is not defined on a distributed
frame), numbered 1..n and the lists are full-outer-joined on that number.

Numbering is distributed (``ordinal``): a range partitioning sorts the members across
tasks and the sorted partitions are written with their number and each row's place in
them; sizes and offsets of the partitions come from that written table, so they always
belong to the same partitioning.  No task ever holds more than its own partition.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosband.operators.joins import materialize
from rosband.operators.numbers import ordinal
from rosband.sources import manifest
from rosband.sources.snapshot import write_dataset


def report_lists(published: DataFrame, columns: Sequence[str], position: str = "position") -> DataFrame:
    """Zip the sorted distinct members of ``columns`` by position.

    The needed columns of ``published`` are written once (a published table is
    bounded by cells x bands) so the lists do not each re-run the job behind it.
    """
    src = materialize(published.select(*columns))
    out = None
    for c in columns:
        lst = ordinal(src.select(c).where(F.col(c).isNotNull()).distinct(), c, position)
        out = lst if out is None else out.join(lst, position, "full_outer")
    return out.select(position, *columns)


def write_report(sheets: dict[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    """Write one dataset per sheet under ``root`` (the workbook of the analysed job)."""
    for name, df in sheets.items():
        write_dataset(df, f"{root.rstrip('/')}/{name}", fmt)


class ReportRun:
    """One version of a report's sheets under ``root``; readers see it as a whole once it is committed.

    ``with ReportRun(spark, root) as run: run.write({...})`` writes to a fresh folder and commits at the end of the block.
    When the block fails, nothing is committed and the run's folder is deleted; earlier versions stay readable.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.name = f"run-{uuid.uuid4().hex}"
        self.sheets: dict[str, dict] = {}

    def __enter__(self) -> ReportRun:
        return self

    def __exit__(self, failure, *_) -> None:
        if failure is None:
            manifest.commit(self.spark, self.root, {"run": self.name, "sheets": self.sheets})
        else:
            fs, folder = manifest.file_system(self.spark, f"{self.root}/{self.name}")
            fs.delete(folder, True)

    def write(self, sheets: dict[str, DataFrame]) -> None:
        for name, df in sheets.items():
            write_dataset(df, f"{self.root}/{self.name}/{name}", self.fmt)
            self.sheets[name] = {"schema": df.schema.json(), "format": self.fmt}

    def read(self, name: str) -> DataFrame:
        """A sheet that this run has written, before or after its commit."""
        return _sheet(self.spark, f"{self.root}/{self.name}/{name}", self.sheets[name])


def _sheet(spark: SparkSession, path: str, about: dict) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(about["schema"]))
    return spark.read.schema(schema).format(about["format"]).options(header="true").load(path)


def read_sheet(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A sheet of the newest committed version."""
    content = manifest.current(spark, root)
    if content is None or name not in content["sheets"]:
        raise LookupError(f"no committed sheet {name} under {root}")
    return _sheet(spark, f"{root.rstrip('/')}/{content['run']}/{name}", content["sheets"][name])
