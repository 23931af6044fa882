"""Cut lineage between tiers through tables in shared storage, and remove them again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_scratch: ContextVar[tuple[str, list[str]] | None] = ContextVar("scratch", default=None)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tiercast-stage-")


def stage_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names, or the open scratch folder in it; a temporary one only in local mode."""
    held = _scratch.get()
    if held:
        return held[0]
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    return _local_folder()


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` out and read it back (an action).

    Each tier asks the last one's result twice - for the rows themselves and for
    the addresses they need - so the result is worth keeping, and a written table
    survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def register(table: str) -> None:
    """Have a named table of the staging folder dropped with the open scratch folder."""
    held = _scratch.get()
    if held:
        held[1].append(table)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of shared storage, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """All that is staged inside goes to one folder, which is removed at the end.

    What comes out of it must be written elsewhere before the end.
    """
    folder = f"{stage_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    tables: list[str] = []
    token = _scratch.set((folder, tables))
    try:
        yield folder
    finally:
        _scratch.reset(token)
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(spark, folder)
