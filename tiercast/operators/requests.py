"""Requests: which (company, year, metric) values are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast import vocabulary as V


TASK_ROWS = 1_000_000  # requests that one task unfolds


def spread(ciks: DataFrame, key: str, times: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """The keys in so many partitions by ``key`` that each unfolds into about ``task_rows`` rows, ``times`` per key.

    A file of keys is a split or two however many rows they unfold into. Keys are counted
    first (an action); few are left where they lie. What follows by key needs no more exchange.
    """
    tasks = -(-ciks.count() * times // task_rows)
    least = ciks.sparkSession.sparkContext.defaultParallelism
    return ciks.repartition(max(tasks, least), key) if tasks > 1 else ciks


def requests(ciks: DataFrame, years, metrics: dict[str, str]) -> DataFrame:
    """Every company times every year times every metric.

    Years and metrics are short lists known when the plan is built, so they are
    unfolded from literal arrays: no cross join, and what moves is at most the keys.
    """
    years = [int(y) for y in years]
    ciks = spread(ciks.select(F.col("cik").cast("bigint").alias("cik")), "cik", len(years) * len(metrics))
    pairs = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(c).alias("c")) for m, c in metrics.items()])
    per_year = ciks.select("cik", F.explode(F.array(*[F.lit(y) for y in years])).alias("year"))
    return per_year.select("cik", "year", F.explode(pairs).alias("p")).select(
        "cik", "year", F.col("p.m").alias("metric_name"), F.col("p.c").alias("xbrl_column")
    )


def cik_frame(spark: SparkSession, ciks) -> DataFrame:
    return spark.createDataFrame([(int(c),) for c in ciks], "cik bigint")


def first_entities(entities: DataFrame) -> DataFrame:
    """One entity per key: the first in file order."""
    text = lambda c: F.coalesce(F.col(c), F.lit(V.MISSING_TEXT)).alias(c)
    first = entities.groupBy("cik").agg(F.min_by(F.struct(text("ticker"), text("name")), "src_pos").alias("e"))
    return first.select("cik", F.col("e.ticker").alias("_ticker"), F.col("e.name").alias("_name"))


def with_entity(reqs: DataFrame, entities: DataFrame) -> DataFrame:
    """Add ``ticker`` and ``company_name``; unknown companies get defaults."""
    joined = reqs.join(first_entities(entities), "cik", "left")
    return joined.select(
        *reqs.columns,
        F.coalesce("_ticker", F.lit(V.NOT_AVAILABLE)).alias("ticker"),
        F.coalesce("_name", F.concat(F.lit("CIK_"), F.col("cik").cast("string"))).alias("company_name"),
    )
