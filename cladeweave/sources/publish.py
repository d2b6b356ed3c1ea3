"""Runs that appear as a whole.

The tables of a run go to a folder of their own, and only when all are written a manifest is
put beside the earlier ones: written under another name and renamed, which is one step, so a
reader sees the whole run or none of it. It holds the schemas too, as a table without rows
has no files. Readers take the manifest of the highest number. A
run that fails leaves folders that no manifest names; earlier runs stay readable. Two runs
that publish at once cannot both get the same number: the second rename fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import staging

_DIGITS = 12


class PublishError(RuntimeError):
    """A manifest could not be put in its place."""


def _path(spark: SparkSession, text: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published runs below ``root``, in order."""
    folder, fs = _path(spark, f"{root}/manifests")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict[str, tuple[str, T.StructType]]:
    """Folder and schema of every table of a run, of the last one by default."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"no published run {'' if version is None else version} in {root}")
    number = known[-1] if version is None else version
    # read by Spark, which knows every file system that the tables can be in
    (line,) = spark.read.text(f"{root}/manifests/{number:0{_DIGITS}}.json", wholetext=True).collect()
    tables = json.loads(line.value).items()
    return {name: (f"{root}/{t['folder']}", T.StructType.fromJson(t["schema"])) for name, t in tables}


def read_run(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables of a published run, the last one by default."""
    return {
        name: spark.read.schema(schema).parquet(folder).select(*schema.names)
        for name, (folder, schema) in manifest(spark, root, version).items()
    }


def publish(spark: SparkSession, root: str, tables: dict[str, tuple[DataFrame, list[str] | None]]) -> int:
    """Write ``tables`` (rows and partition columns by name) and publish them together.

    Gives the number of the run. Tables may be made from an earlier run in ``root``, as
    nothing is overwritten.
    """
    root = root.rstrip("/")
    run = f"runs/{uuid.uuid4().hex}"
    for name, (df, partition_by) in tables.items():
        staging.write_table(df, f"{root}/{run}/{name}", partition_by, mode="error")
    number = (versions(spark, root) or [0])[-1] + 1
    final, fs = _path(spark, f"{root}/manifests/{number:0{_DIGITS}}.json")
    unnamed, _ = _path(spark, f"{root}/manifests/.{uuid.uuid4().hex}")
    out = fs.create(unnamed, False)
    try:
        listed = {name: {"folder": f"{run}/{name}", "schema": df.schema.jsonValue()} for name, (df, _) in tables.items()}
        out.write(bytearray(json.dumps(listed).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(unnamed, final):
        raise PublishError(f"run {number} of {root} was published by another job at the same time")
    return number
