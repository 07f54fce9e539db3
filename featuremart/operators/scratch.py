"""Shared scratch space: results that are read more than once, or that must cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by the cluster in ``spark.checkpoint.dir``.

    Where nothing is set, a session on one machine (``local[...]``) makes itself a temporary folder;
    on a cluster that is an error, as executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="featuremart-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the scratch folder that no other run uses."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _SCOPES[-1:]:
        made.append(path)
    return path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside when the block ends; results must be written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            forget(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the scratch folder and go on from the written table.

    Unlike a cached result the written one survives lost executors, and the readers still
    get column pruning and filter pushdown.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
