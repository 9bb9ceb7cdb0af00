"""Snapshot-or-compute: reuse a Parquet dataset when it is complete, else build it.

The analysed job keeps its extract as a local Parquet file and skips the pull
when the file exists.  Here the snapshot is a Parquet *dataset* on shared
storage; it counts as present only when Spark's ``_SUCCESS`` marker exists, so
a job that died half-way is recomputed rather than read.  The frame's schema is
kept beside the data: values of partition directories come back with the types
they were written with ("01" stays a string).

``incremental_snapshot`` does so by period: every refresh pulls the periods whose version has changed and writes them
to a folder of its own; a manifest says which folder holds which period.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosband.sources import manifest


def _complete(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return p.getFileSystem(hconf).exists(p)


def snapshot(
    spark: SparkSession,
    path: str,
    compute: Callable[[SparkSession], DataFrame],
    partition_by: Sequence[str] | None = None,
    refresh: bool = False,
) -> DataFrame:
    """Return the dataset at ``path``, computing and writing it first if needed."""
    schema_path = f"{path.rstrip('/')}/_schema"
    if refresh or not _complete(spark, path) or not _complete(spark, schema_path):
        df = compute(spark)
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        # a literal: rows from Python would start Python workers
        spark.range(1).select(F.lit(df.schema.json()).alias("value")).coalesce(1).write.mode("overwrite").text(schema_path)
    schema = T.StructType.fromJson(json.loads(spark.read.text(schema_path).first()["value"]))
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


_RUN = "__run"


def incremental_snapshot(
    spark: SparkSession,
    path: str,
    compute: Callable[[SparkSession, list], DataFrame],
    versions: Mapping,
    by: str = "period",
) -> DataFrame:
    """The rows of the periods in ``versions``, pulling only those whose version is not the one kept at ``path``.

    ``versions`` maps each period to a version as the source states it (a load number, a time of change);
    ``compute(spark, periods)`` pulls the rows of the given periods.  Changed and new periods are written to one fresh folder,
    laid out by period, and become visible together when the manifest is committed; other periods stay where they are.
    A period that has become empty has no rows from then on, one that is no longer in ``versions`` is not read.
    A pull that dies changes nothing.  Periods with another schema than the kept one are an error: use a new path.
    """
    path = path.rstrip("/")
    kept = manifest.current(spark, path) or {"schema": None, "periods": {}}
    done = kept["periods"]
    stale = [v for v, version in versions.items() if done.get(str(v), {}).get("version") != str(version)]
    if stale or set(done) != {str(v) for v in versions}:
        run, schema = uuid.uuid4().hex, kept["schema"]
        if stale:
            df = compute(spark, stale).where(F.col(by).isin(stale))
            if schema is not None and T.StructType.fromJson(json.loads(schema)).simpleString() != df.schema.simpleString():
                raise ValueError(f"the pull has another schema than the snapshot at {path}")
            schema = schema or df.schema.json()
            df.write.partitionBy(by).parquet(f"{path}/{_RUN}={run}")
        fresh = {str(v): {"version": str(versions[v]), "run": run} for v in stale}
        same = {str(v): done[str(v)] for v in versions if str(v) not in fresh}
        kept = {"schema": schema, "periods": {**same, **fresh}}
        manifest.commit(spark, path, kept)
    if kept["schema"] is None:
        raise ValueError("a snapshot needs a period to learn its schema from")
    schema = T.StructType.fromJson(json.loads(kept["schema"]))
    runs: dict[str, list] = {}
    for v in versions:
        runs.setdefault(kept["periods"][str(v)]["run"], []).append(v)
    if not runs:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(_RUN, T.StringType())])).parquet(path)
    chosen = [(F.col(_RUN) == run) & F.col(by).isin(values) for run, values in runs.items()]
    return rows.where(reduce(lambda a, b: a | b, chosen)).select(*schema.fieldNames())


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders of an incremental snapshot that its manifest no longer names; returns how many.

    Call it when no reader of an older state is left."""
    fs, root = manifest.file_system(spark, path.rstrip("/"))
    kept = manifest.current(spark, path) or {"periods": {}}
    named = {f"{_RUN}={p['run']}" for p in kept["periods"].values()}
    old = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(f"{_RUN}=")]
    return sum(bool(fs.delete(p, True)) for p in old if p.getName() not in named)


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None) -> None:
    """Sink for result tables (one dataset per report sheet)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
