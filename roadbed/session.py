"""Stage tables: cut lineage through files every executor can read again."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: folder below the stage root that stage tables go to just now
_SCOPE: ContextVar[str] = ContextVar("stage scope", default="")


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    A cluster installs the package or ships it with ``--py-files``; this is for
    sessions that were started in another folder.
    """
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def stage_root(spark: SparkSession) -> str:
    """Shared folder for stage tables, as the cluster names it.

    Only a local session may fall back to a folder of its own; on a cluster a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="roadbed-")
    context.setCheckpointDir(root)
    return root


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet and go on from the written table.

    Later readers prune columns and push filters into it, a lost executor
    rereads files instead of recomputing the whole chain, and values that
    depend on how rows were laid out (row ids) are fixed for good.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{_SCOPE.get()}{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Stage tables of what runs inside are removed at its end, also if it fails.

    Frames that were made inside read those tables: write what is wanted before.
    """
    folder = f"job-{uuid.uuid4().hex}/"
    token = _SCOPE.set(_SCOPE.get() + folder)
    try:
        yield
    finally:
        path = f"{stage_root(spark)}/{_SCOPE.get()}"
        _SCOPE.reset(token)
        remove(spark, path)


def _located(spark: SparkSession, path: str):
    """A path and the file system it is in, which Spark's readers and writers use."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _located(spark, path)
    return files.exists(place)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    place, files = _located(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; one that is not there is no error."""
    place, files = _located(spark, path)
    files.delete(place, True)
