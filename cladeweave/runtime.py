"""Session helpers: intermediate tables in the shared folder, name equality."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .model import ROOT_NAME

BINARY = "UTF8_BINARY"
#: equality that ignores case and accents
DEFAULT_COLLATION = "UNICODE_CI_AI"

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables of this application.

    It lies below ``spark.checkpoint.dir``, which has to be shared storage. Only
    a local session without that setting gets a temporary folder of its own.
    """
    app = spark.conf.get("spark.app.id")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="cladeweave-")
        base = _local_roots[app]
    return f"{base.rstrip('/')}/cladeweave/{app}"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the tables stored within this block when it ends.

    What is stored with ``keep`` belongs to the block around it, or lasts.
    """
    outer = _scopes.get()
    made: list[str] = []
    token = _scopes.set((*outer, made))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in made:
            _delete(spark, path)


def store(df: DataFrame, name: str, keep: bool = False) -> str:
    """Write ``df`` as an intermediate table and give its path."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    scopes = _scopes.get()
    scopes = scopes[:-1] if keep else scopes
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return path


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as a table and read it back: lineage ends here.

    Unlike cached blocks the table survives lost executors, and its file sizes
    give the optimizer true statistics for the joins that follow.
    """
    return df.sparkSession.read.schema(df.schema).parquet(store(df, name, keep))


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is not broadcast unless it is counted first.

    Spark would go by the size of compressed files, of which a few megabytes can be
    many rows, and every such table passes through the driver.
    """
    return df.hint("merge")


def release(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application."""
    _delete(spark, scratch_root(spark))


def name_key(column: Column | str, collation: str = DEFAULT_COLLATION) -> Column:
    """``column`` as a comparison key under ``collation``."""
    column = F.col(column) if isinstance(column, str) else column
    return column if collation == BINARY else F.collate(column, collation)


def same_name(left: Column | str, right: Column | str, collation: str = DEFAULT_COLLATION) -> Column:
    return name_key(left, collation) == name_key(right, collation)


def is_root(collation: str = DEFAULT_COLLATION) -> Column:
    """Whether a row is a root; a row without name is none."""
    return F.coalesce(same_name("taxon", F.lit(ROOT_NAME), collation), F.lit(False))
