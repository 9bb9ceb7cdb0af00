"""Numbered manifests beside datasets: what readers of a folder may see.

Rows are written to fresh folders first; then a manifest that names them is written under ``_manifests`` (a name that
Spark's readers pass over), to a file of its own that is renamed into place.  Readers follow the manifest with the highest
number, so they see all of a change or nothing of it, and a writer that dies leaves the last state as it was.  Manifests hold
names and versions only, never rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_manifests"


def file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it knows it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = file_system(spark, f"{root}/{FOLDER}")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def current(spark: SparkSession, root: str) -> dict | None:
    """The newest manifest of ``root``; None where there is none."""
    numbers = _numbers(spark, root.rstrip("/"))
    if not numbers:
        return None
    fs, p = file_system(spark, f"{root.rstrip('/')}/{FOLDER}/{numbers[-1]:010d}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, content: dict) -> int:
    """Make ``content`` the newest manifest of ``root``; returns its number."""
    root = root.rstrip("/")
    fs, draft = file_system(spark, f"{root}/{FOLDER}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    numbers = _numbers(spark, root)
    number = numbers[-1] + 1 if numbers else 1
    _, final = file_system(spark, f"{root}/{FOLDER}/{number:010d}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer has committed to {root}")
    return number
