"""The whole batch from files: sweep, statements, model, ordered results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tiercast.operators.results import loop_order, render
from tiercast.plans import cascade, tier1
from tiercast.plans.collections import Collections
from tiercast.plans.handoff import Handoff, digest_of, digest_of_files, digest_of_rows
from tiercast.plans.staging import scratch
from tiercast.plans.tier3 import Hook
from tiercast.sources import documents, tables
from tiercast.sources.catalogue import catalogue_columns, read_catalogue
from tiercast.sources.sinks import write_ordered_csv


@dataclass(frozen=True)
class Inputs:
    """Where the inputs lie: CSV tables, a JSON catalogue, JSON feeds, landed documents as Parquet."""

    catalogue: str
    entities: str
    filings: str
    facts: tuple[str, ...]  # the first that exists is read
    feeds: str
    documents: str


def run(
    spark: SparkSession,
    inputs: Inputs,
    ciks: DataFrame,
    years,
    embed: Hook,
    answer: Hook,
    folder: str,
    results: str | None = None,
    policy: cascade.Policy = cascade.BATCH,
    unique: bool = False,
    hooks: str = "",
    kept: Collections | None = None,
) -> Handoff:
    """Take requests from files through all tiers; stages ``tier1``, ``tier2`` and ``tier3`` lie in ``folder``.

    A rerun builds only stages whose inputs changed, or that an earlier run did not finish.  ``hooks`` names
    the version of the two hooks, whose code no digest can see.  With ``results`` the record is written
    there as CSV in loop order; with ``kept`` vectors last from one batch to the next.
    """
    years = list(years)
    handed = Handoff(spark, folder)
    feeds = digest_of_files(spark, inputs.feeds)

    def sweep() -> DataFrame:
        facts = tables.read_facts(spark, *inputs.facts)
        return tier1.sweep(ciks, years, metrics, tables.read_entities(spark, inputs.entities), tables.read_filings(spark, inputs.filings), facts)

    def submissions() -> DataFrame:
        return documents.read_submissions(spark, inputs.feeds)

    metrics = catalogue_columns(read_catalogue(spark, inputs.catalogue))
    structured = digest_of_files(spark, inputs.entities, inputs.filings, *inputs.facts)
    first = digest_of("tier1", digest_of_rows(ciks), years, metrics, structured)
    tier_1 = handed.table("tier1", first, sweep)

    docs = documents.read_documents(spark, inputs.documents)
    landed = digest_of_files(spark, inputs.documents)
    second = digest_of("tier2", first, landed, feeds if policy.url_first else None, policy, unique)
    tier_2 = handed.table("tier2", second, lambda: cascade.statements(tier_1, submissions, docs, policy, unique))

    third = digest_of("tier3", second, feeds, hooks)
    tier_3 = handed.table("tier3", third, lambda: cascade.passages(tier_2, submissions, docs, embed, answer, policy, unique, kept=kept).select(*tier_1.columns))
    if results:
        with scratch(spark):
            write_ordered_csv(render(tier_3), results, *loop_order(metrics))
    return handed


def result(handed: Handoff) -> DataFrame:
    """The last stage's table."""
    return handed.spark.read.parquet(handed._manifest("tier3").path)
