"""Landed documents that grow snapshot by snapshot, in buckets of their address.

A landing writes only rows that are new or that win against the row an address has: the
smaller by status, then content digest, so that any order of landings ends alike.  Rows that lost stay
in their files and are hidden when the table is read.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast.plans.staging import stage

_COLUMNS = "url STRING, html STRING, status INT, digest STRING"


def _rank():
    # A row without a status ranks first, as in ``one_per_url``.
    return F.struct("status", "digest")


def _buckets(spark: SparkSession, folder: str) -> int | None:
    try:
        return spark.read.schema("buckets int").json(f"{folder}/layout").first().buckets
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _table(spark: SparkSession, folder: str, buckets: int) -> str:
    """The name under which this session knows the folder."""
    name = f"landing_{hashlib.md5(folder.encode()).hexdigest()}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS}) USING parquet CLUSTERED BY (url) SORTED BY (url) "
        f"INTO {buckets} BUCKETS LOCATION '{folder}/rows'"
    )
    return name


def land_into(docs: DataFrame, folder: str, buckets: int | None = None) -> DataFrame:
    """Land a snapshot of ``url, html, status`` in ``folder``, and return the table so far.

    ``buckets`` (the number of shuffle partitions by default) is fixed by the first landing.  Bodies
    that are there already are neither read nor written; a repeated landing writes nothing.
    """
    spark, folder = docs.sparkSession, folder.rstrip("/")
    known = _buckets(spark, folder)
    if known is None:
        known = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.createDataFrame([(known,)], "buckets int").coalesce(1).write.mode("overwrite").json(f"{folder}/layout")
    name = _table(spark, folder, known)
    named = docs.filter(F.col("url").isNotNull()).select("url", "html", F.col("status").cast("int").alias("status"), F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"))
    # One exchange by address serves the choice of a row, the look at what is there, and the writing.
    fresh = named.repartition(known, "url").groupBy("url").agg(F.min_by(F.struct("html", "status", "digest"), _rank()).alias("d")).select("url", "d.*")
    held = spark.table(name).select("url", "status", "digest").groupBy("url").agg(F.min(_rank()).alias("held"))
    wins = fresh.join(held, "url", "left").filter(F.col("held").isNull() | (_rank() < F.col("held"))).select("url", "html", "status", "digest")
    staged = stage(wins, "landing")  # the table cannot be read and written at once
    staged.repartition(known, "url").write.insertInto(name)
    return landed(spark, folder)


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """``url, html, status``: one row per landed address, in buckets of it.

    Which rows lost is told by a scan of addresses, statuses and digests (an action); bodies stay where
    they lie.
    """
    folder = folder.rstrip("/")
    buckets = _buckets(spark, folder)
    if buckets is None:
        raise ValueError(f"nothing was landed in {folder}")
    rows = spark.table(_table(spark, folder, buckets))
    several = rows.groupBy("url").agg(F.min(_rank()).alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("url", "best")
    several = stage(several, "landed-again")
    if several.isEmpty():
        return rows.select("url", "html", "status")
    whole = rows.join(several, "url", "left").filter(F.col("best").isNull() | (_rank() == F.col("best")))
    return whole.select("url", "html", "status")
