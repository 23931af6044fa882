"""Small helpers that the operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast.plans.staging import register, stage_folder


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as ``_row`` beside new columns, so that no name of the input can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def wide_hash(*columns: Column) -> Column:
    """128 bits of two differently salted hashes."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(0x5EED), *columns).alias("b"))


def stage_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df`` to the shared folder in buckets of ``key``, so that grouping by it later moves no row."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    register(table)
    df.write.format("parquet").bucketBy(buckets, key).option("path", f"{stage_folder(spark).rstrip('/')}/{table}").saveAsTable(table)
    return spark.table(table)
