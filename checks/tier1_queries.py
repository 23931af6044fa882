"""Structured look-up: requests, entities, facts, filings, the sweep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins as S
from tiercast.functions.numbers import coerce_key, parse_year
from tiercast.operators.facts import long_facts, ranked_facts
from tiercast.operators.filings import ranked_filings, with_filing
from tiercast.operators.requests import requests, with_entity
from tiercast.operators.results import in_loop_order, preview, tier_counts
from tiercast.operators.sampling import first_per_key, stable_pick, stable_sample
from tiercast.plans import tier1
from tiercast.vocabulary import METRIC_COLUMNS, VERIFY_METRICS

METRICS = dict(METRIC_COLUMNS)


def _dirty(spark, sf):
    k = F.col("c_custkey").cast("string")
    pick = F.col("c_custkey") % 12
    text = (
        F.when(pick == 0, k)
        .when(pick == 1, F.concat(k, F.lit(".0")))
        .when(pick == 2, F.concat(F.lit("CIK"), k))
        .when(pick == 3, F.lit(""))
        .when(pick == 4, F.lit(None).cast("string"))
        .when(pick == 5, F.concat(F.lit("  "), k, F.lit(" ")))
        .when(pick == 6, F.concat(k, F.lit("e1")))
        .when(pick == 8, F.concat(k, F.lit("f")))
        .when(pick == 9, F.concat(k, F.lit("d")))
        .when(pick == 10, F.lit("inf"))
        .when(pick == 11, F.lit("1e300"))
        .otherwise(F.concat(F.lit("-"), k, F.lit(".9")))
    )
    return S.table(spark, sf, "customer").select("c_custkey", text.alias("dirty"))


def key_coercion(spark: SparkSession, sf: str) -> DataFrame:
    return _dirty(spark, sf).select(
        "c_custkey", coerce_key(F.col("dirty")).alias("cik"), parse_year(F.col("dirty")).alias("year")
    )


KEY_COERCION = """
SELECT c_custkey,
  CAST(CASE c_custkey % 12 WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey WHEN 5 THEN c_custkey
       WHEN 6 THEN c_custkey * 10 WHEN 7 THEN -c_custkey ELSE 0 END AS BIGINT) AS cik,
  CAST(CASE c_custkey % 12 WHEN 0 THEN c_custkey WHEN 5 THEN c_custkey ELSE 0 END AS INTEGER) AS year
FROM customer
"""


def entity_defaults(spark, sf):
    reqs = S.given(spark, sf, "ciks")
    return with_entity(reqs, S.given(spark, sf, "entities"))


ENTITY_DEFAULTS = f"""
WITH ciks AS ({S.CIKS})
SELECT cik, coalesce(c_mktsegment, 'N/A') AS ticker, coalesce(c_name, 'CIK_' || cik) AS company_name
FROM ciks LEFT JOIN customer ON c_custkey = cik
"""


def request_grid(spark, sf):
    grid = requests(S.given(spark, sf, "ciks"), S.SWEEP_YEARS, METRICS)
    return grid.groupBy("metric_name", "xbrl_column", "year").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("cik").alias("n_ciks")
    )


REQUEST_GRID = f"""
WITH ciks AS ({S.CIKS}), m(metric_name, xbrl_column) AS (VALUES
  ('ResearchAndDevelopment', 'ResearchAndDevelopmentExpense'), ('SalesRevenueNet', 'SalesRevenueNet'), ('NetIncomeLoss', 'NetIncomeLoss'))
SELECT metric_name, xbrl_column, y AS year, count(*) AS n, count(DISTINCT cik) AS n_ciks
FROM ciks, m, (SELECT unnest({list(S.SWEEP_YEARS)}) AS y) GROUP BY ALL
"""

_LONG = f"""
facts AS ({S.WIDE_FACTS}),
long AS (
  SELECT entitycentralindexkey AS cik, documentfiscalyearfocus AS fy, start_date, end_date, src_pos, 'SalesRevenueNet' AS xbrl_column, SalesRevenueNet AS value FROM facts WHERE SalesRevenueNet IS NOT NULL
  UNION ALL SELECT entitycentralindexkey, documentfiscalyearfocus, start_date, end_date, src_pos, 'NetIncomeLoss', NetIncomeLoss FROM facts WHERE NetIncomeLoss IS NOT NULL
  UNION ALL SELECT entitycentralindexkey, documentfiscalyearfocus, start_date, end_date, src_pos, 'ResearchAndDevelopmentExpense', ResearchAndDevelopmentExpense FROM facts WHERE ResearchAndDevelopmentExpense IS NOT NULL)
"""


def wide_to_long_facts(spark, sf):
    facts = long_facts(S.given(spark, sf, "wide_facts"), METRICS.values())
    return facts.select("cik", F.col("fy").cast("int").alias("fy"), "start_date", "end_date", "xbrl_column", "value", "src_pos")


WIDE_TO_LONG = f"""
WITH {_LONG}
SELECT cik, CAST(fy AS INTEGER) AS fy, start_date, coalesce(end_date, 'nan') AS end_date, xbrl_column, value, src_pos FROM long
"""


def fact_ranking(spark, sf):
    by_year, any_year = ranked_facts(long_facts(S.given(spark, sf, "wide_facts"), METRICS.values()))
    return by_year.join(any_year, ["cik", "xbrl_column"]).select(
        "cik",
        "xbrl_column",
        "yr",
        F.col("by_end.value").alias("by_end"),
        F.col("by_fy.value").alias("by_fy"),
        F.col("any_row.value").alias("any_row"),
    )


FACT_RANKING = f"""
WITH {_LONG},
keys AS (SELECT DISTINCT cik, xbrl_column, yr FROM (
  SELECT cik, xbrl_column, CAST(fy AS VARCHAR) AS yr FROM long UNION ALL SELECT cik, xbrl_column, end_date[1:4] FROM long WHERE end_date IS NOT NULL)),
e AS (SELECT cik, xbrl_column, end_date[1:4] AS yr, value FROM long WHERE end_date IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY cik, xbrl_column, end_date[1:4] ORDER BY src_pos) = 1),
f AS (SELECT cik, xbrl_column, CAST(fy AS VARCHAR) AS yr, value FROM long
      QUALIFY row_number() OVER (PARTITION BY cik, xbrl_column, fy ORDER BY end_date DESC NULLS LAST, src_pos) = 1),
a AS (SELECT cik, xbrl_column, value FROM long QUALIFY row_number() OVER (PARTITION BY cik, xbrl_column ORDER BY src_pos) = 1)
SELECT k.cik, k.xbrl_column, k.yr, e.value AS by_end, f.value AS by_fy, a.value AS any_row
FROM keys k LEFT JOIN e USING (cik, xbrl_column, yr) LEFT JOIN f USING (cik, xbrl_column, yr) JOIN a USING (cik, xbrl_column)
"""


def filing_lookup(spark, sf):
    years = S.SWEEP_YEARS + (0,)
    grid = requests(S.given(spark, sf, "ciks"), years, {"m": "c"}).select("cik", "year")
    return with_filing(grid, S.given(spark, sf, "filings"))


_FILING_PICK = """
filed AS (SELECT r.cik, r.year, accessionNo, linkToHtml, src_pos,
    CASE WHEN starts_with(coalesce(periodOfReport, 'nan'), CAST(year AS VARCHAR)) THEN 0
         WHEN contains(filedAt, CAST(year AS VARCHAR)) OR contains(filedAt, CAST(year + 1 AS VARCHAR)) THEN 1 END AS lvl
  FROM reqs r JOIN filings f ON f.cik = r.cik AND formType = '10-K'),
filing AS (SELECT cik, year, accessionNo AS accession_no, linkToHtml AS edgar_url FROM filed WHERE lvl IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY cik, year ORDER BY lvl, src_pos) = 1)
"""

FILING_LOOKUP = f"""
WITH ciks AS ({S.CIKS}), filings AS ({S.FILINGS}),
reqs AS (SELECT cik, y AS year FROM ciks, (SELECT unnest({list(S.SWEEP_YEARS + (0,))}) AS y)),
{_FILING_PICK}
SELECT cik, year, coalesce(accession_no, 'UNKNOWN') AS accession_no, coalesce(edgar_url, 'UNKNOWN') AS edgar_url
FROM reqs LEFT JOIN filing USING (cik, year)
"""


def _sweep(spark, sf):
    return tier1.sweep(
        S.given(spark, sf, "ciks"),
        S.SWEEP_YEARS,
        METRICS,
        S.given(spark, sf, "entities"),
        S.given(spark, sf, "filings"),
        S.given(spark, sf, "wide_facts"),
    )


def tier1_sweep(spark, sf):
    return _sweep(spark, sf).drop("raw_value", "status")


def sweep_cte(years, ciks=S.CIKS):
    return f"""
ciks AS ({ciks}), filings AS ({S.FILINGS}), {_LONG},
m(metric_name, xbrl_column) AS (VALUES
  ('ResearchAndDevelopment', 'ResearchAndDevelopmentExpense'), ('SalesRevenueNet', 'SalesRevenueNet'), ('NetIncomeLoss', 'NetIncomeLoss')),
reqs AS (SELECT cik, y AS year FROM ciks, (SELECT unnest({list(years)}) AS y)),
{_FILING_PICK},
cand AS (SELECT r.cik, r.year, m.metric_name, l.*  EXCLUDE (cik),
    CASE WHEN starts_with(coalesce(end_date, ''), CAST(year AS VARCHAR)) THEN 1 WHEN fy = year THEN 2 ELSE 3 END AS lvl
  FROM reqs r CROSS JOIN m JOIN long l ON l.cik = r.cik AND l.xbrl_column = m.xbrl_column),
best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY cik, year, metric_name
    ORDER BY lvl, CASE WHEN lvl = 2 THEN end_date END DESC NULLS LAST, src_pos) = 1),
sweep AS (SELECT concat_ws('_', r.cik, r.year, m.metric_name) AS extraction_id, r.cik,
  coalesce(c_mktsegment, 'N/A') AS ticker, coalesce(c_name, 'CIK_' || r.cik) AS company_name,
  r.year AS document_fiscal_year,
  CASE WHEN b.end_date IS NOT NULL THEN CAST(b.end_date[1:4] AS INTEGER) ELSE r.year END AS metric_fiscal_year,
  CASE WHEN b.value IS NULL THEN 'N/A' ELSE b.start_date END AS period_start_date,
  CASE WHEN b.value IS NULL THEN 'N/A' ELSE coalesce(b.end_date, 'nan') END AS period_end_date,
  m.metric_name, b.value AS extracted_value, 'USD' AS currency,
  CASE WHEN b.value IS NULL THEN 'MISS' ELSE 'TIER_1_XBRL' END AS winning_tier,
  CASE WHEN b.value IS NULL THEN '' ELSE 'xbrl.csv -> Column: ' || m.xbrl_column END AS source_snippet,
  coalesce(f.accession_no, 'UNKNOWN') AS accession_no, coalesce(f.edgar_url, 'UNKNOWN') AS edgar_url,
  'UNVERIFIED' AS audit_status, '' AS audit_notes
FROM reqs r CROSS JOIN m LEFT JOIN customer ON c_custkey = r.cik
LEFT JOIN best b ON b.cik = r.cik AND b.year = r.year AND b.metric_name = m.metric_name
LEFT JOIN filing f ON f.cik = r.cik AND f.year = r.year)
"""

SWEEP_CTE = sweep_cte(S.SWEEP_YEARS)

TIER1_SWEEP = f"WITH {SWEEP_CTE} SELECT * FROM sweep"


def tier1_coverage(spark, sf):
    return tier1.coverage(_sweep(spark, sf))


TIER1_COVERAGE = f"""
WITH {SWEEP_CTE} SELECT count(*) FILTER (WHERE winning_tier = 'TIER_1_XBRL') AS found,
  (SELECT count(*) FROM ciks) * {len(S.SWEEP_YEARS)} * 3 AS requested FROM sweep
"""


def tier1_preview(spark, sf):
    return preview(in_loop_order(_sweep(spark, sf), METRICS))


TIER1_PREVIEW = f"""
WITH {SWEEP_CTE} SELECT extraction_id, company_name, document_fiscal_year, period_start_date, period_end_date, metric_name, extracted_value, winning_tier
FROM sweep
"""


def pending_counts(spark, sf):
    return tier_counts(_sweep(spark, sf))


PENDING_COUNTS = f"""
WITH {SWEEP_CTE} SELECT count(*) AS total, count(*) FILTER (WHERE winning_tier = 'TIER_1_XBRL') AS tier1_found,
  count(*) FILTER (WHERE winning_tier = 'MISS') AS pending_tier2, count(*) FILTER (WHERE extracted_value IS NULL) AS pending_tier3
FROM sweep
"""


def first_row_per_key(spark, sf):
    facts = S.given(spark, sf, "wide_facts").select(
        F.col("entitycentralindexkey").alias("cik"), F.col("documentfiscalyearfocus").alias("year"), "end_date", "src_pos"
    )
    return first_per_key(facts, ["cik", "year"])


FIRST_ROW = f"""
WITH facts AS ({S.WIDE_FACTS})
SELECT entitycentralindexkey AS cik, documentfiscalyearfocus AS year, end_date, src_pos FROM facts
QUALIFY row_number() OVER (PARTITION BY cik, year ORDER BY src_pos) = 1
"""


def sampled_requests(spark, sf):
    keyed = first_row_per_key(spark, sf)
    sample = stable_sample(keyed, "cik", "year")
    return sample.select("cik", "year", stable_pick(VERIFY_METRICS, F.col("cik"), F.col("year")).alias("metric_name"))


SAMPLED = f"""
WITH facts AS ({S.WIDE_FACTS}), keyed AS (
  SELECT DISTINCT entitycentralindexkey AS cik, documentfiscalyearfocus AS year,
    md5(concat_ws('|', entitycentralindexkey, documentfiscalyearfocus, '42')) AS h FROM facts)
SELECT cik, year, ['SalesRevenueNet', 'NetIncomeLoss', 'ResearchAndDevelopment'][
  1 + CAST(list_sum([strpos('0123456789abcdef', h[i]) - 1 for i in range(1, 9)]) AS BIGINT) % 3] AS metric_name
FROM keyed ORDER BY h LIMIT 200
"""

QUERIES = {
    "key_coercion": key_coercion,
    "request_grid": request_grid,
    "entity_defaults": entity_defaults,
    "wide_to_long_facts": wide_to_long_facts,
    "tier1_fact_fallback": fact_ranking,
    "tier1_filing_fallback": filing_lookup,
    "tier1_sweep": tier1_sweep,
    "tier1_coverage": tier1_coverage,
    "tier1_preview": tier1_preview,
    "pending_counts": pending_counts,
    "first_per_key": first_row_per_key,
    "stable_sample": sampled_requests,
}
ORACLES = {
    "key_coercion": KEY_COERCION,
    "request_grid": REQUEST_GRID,
    "entity_defaults": ENTITY_DEFAULTS,
    "wide_to_long_facts": WIDE_TO_LONG,
    "tier1_fact_fallback": FACT_RANKING,
    "tier1_filing_fallback": FILING_LOOKUP,
    "tier1_sweep": TIER1_SWEEP,
    "tier1_coverage": TIER1_COVERAGE,
    "tier1_preview": TIER1_PREVIEW,
    "pending_counts": PENDING_COUNTS,
    "first_per_key": FIRST_ROW,
    "stable_sample": SAMPLED,
}
