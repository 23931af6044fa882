"""Metric catalogue: metric name -> fact column and label aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast import vocabulary as V

CATALOGUE_TYPE = "map<string,struct<xbrl_column:string,table_aliases:array<string>>>"


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """``metric_name, xbrl_column, table_aliases`` from one JSON object."""
    return parse_catalogue(spark.read.text(path, wholetext=True), "value")


def parse_catalogue(df: DataFrame, column: str) -> DataFrame:
    entries = df.select(F.explode(F.from_json(column, CATALOGUE_TYPE)).alias("metric_name", "m"))
    return entries.select("metric_name", "m.xbrl_column", "m.table_aliases")


def default_catalogue() -> dict[str, str]:
    """Metric -> fact column, in result order."""
    return dict(V.METRIC_COLUMNS)


def catalogue_columns(catalogue: DataFrame) -> dict[str, str]:
    """Bring a catalogue to the driver as metric -> column (an action).

    The catalogue is configuration of a handful of rows, and its column names
    must be known before a plan over wide facts can be built.
    """
    return {r["metric_name"]: r["xbrl_column"] for r in catalogue.select("metric_name", "xbrl_column").collect()}
