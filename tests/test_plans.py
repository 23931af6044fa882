"""Shapes that plans must keep."""

import re

import pytest
from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import QUERIES
from tiercast.operators import html as H
from tiercast.operators.landed import dealt
from tiercast.operators.requests import requests, spread
from tiercast.plans.tier2 import scrape

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["tier1_sweep", "tier1_fact_fallback", "tier1_filing_fallback", "url_recovery", "statement_pick", "text_chunks", "nearest_chunks", "answers"]
)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert bad not in plan


def test_html_takes_one_exchange_and_reads_each_document_once(spark):
    plan = plan_of(H.parse(S.table(spark, SF, "pages"), "page_id"))
    assert plan.count("Exchange") == 1
    assert "Join" not in plan
    # The cell pattern stands in the plan once: nothing computes cells twice.
    assert plan.count("</(?i:td|th)\\s*+>\\s*+(?=") <= 1
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan


def test_chunks_move_nothing(spark):
    assert "Exchange" not in plan_of(QUERIES["text_chunks"](spark, SF))


def test_documents_are_dealt_by_bytes(spark):
    """One file split becomes tasks of about the same markup, and the parser's windows move nothing more."""
    rows = [(f"u{k}", "<p>x</p>" * (1 + k % 40)) for k in range(4000)]
    docs = spark.createDataFrame(rows, "url string, html string").coalesce(1)
    total = sum(len(h) for _, h in rows)
    many = dealt(docs, task_bytes=total // 20)
    loads = sorted(r.n for r in many.groupBy(F.spark_partition_id()).agg(F.sum(F.length("html")).alias("n")).collect())
    assert 18 <= len(loads) <= 22 and sum(loads) == total
    assert loads[-1] <= 3 * loads[len(loads) // 2]
    plan = plan_of(H.parse(many, "url"))
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert dealt(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bucketed", [False, True])
def test_only_unbucketed_documents_are_dealt(spark, bucketed):
    docs = spark.createDataFrame([("a", "<p>x</p>", 200), ("b", None, 200)], "url string, html string, status int")
    asked = spark.createDataFrame([("a", "m", 2014), ("b", "m", 2014), ("c", "m", 2014)], "url string, metric_name string, year int")
    done = scrape(asked, docs, F.lit(True), F.col("url"), F.col("year"), unique=True, bucketed=bucketed)
    assert ("REPARTITION_BY_NUM" in plan_of(done)) != bucketed
    assert sorted((r.url, r.t2.status) for r in done.collect()) == [("a", "NO_TABLES"), ("b", "DOWNLOAD_FAILED"), ("c", "DOWNLOAD_FAILED")]


def test_keys_of_one_split_unfold_in_many_tasks(spark):
    """Requests are many times their keys, so keys are dealt before they unfold; distinct counts then move nothing more."""
    ciks = spark.range(3000).select(F.col("id").alias("cik")).coalesce(1)
    dealt_out = spread(ciks, "cik", 18, task_rows=5400)
    assert dealt_out.rdd.getNumPartitions() == 10 and dealt_out.count() == 3000
    assert spread(ciks, "cik", 18).rdd.getNumPartitions() == 1
    many = requests(spark.range(60_000).select(F.col("id").alias("cik")).coalesce(1), range(2000, 2010), {"a": "A", "b": "B", "c": "C"})
    grid = many.groupBy("metric_name", "year").agg(F.countDistinct("cik").alias("n"))
    assert "REPARTITION_BY_NUM" in plan_of(grid)
    assert {r.n for r in grid.collect()} == {60_000}


def test_requests_are_not_broadcast(spark):
    """Sizes of files say nothing about the rows that companies unfold into."""
    plan = plan_of(QUERIES["year_column"](spark, SF))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_pages_are_spread_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(S, "TASK_PAGES", 3)
    pages = S.statement_pages(S.given(spark, SF, "year_figures"))
    n = pages.select("cik").distinct().count()
    assert pages.rdd.getNumPartitions() >= 0.9 * n / 3


def test_requests_are_joined_by_company_alone(spark):
    """Dealt by company before they unfold, requests need no exchange for filings and facts of a year."""
    joins = re.findall(r"Join \[([^\]]*)\]", plan_of(QUERIES["tier1_sweep"](spark, SF)))
    assert len(joins) >= 3 and all("," not in keys for keys in joins)
