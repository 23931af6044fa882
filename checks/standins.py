"""Inputs of the engine, derived by Spark from the given tables.

``SQL_INPUTS`` are written in SQL that both Spark and the checking database read,
so both sides start from the same rows.  HTML, JSON and feeds are rendered by
Spark only: the checking side computes what must come out of them from the
tables they were rendered from and never sees the rendering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITIES = """
SELECT c_custkey AS cik, c_mktsegment AS ticker, c_name AS name, c_custkey AS src_pos FROM customer
"""

# Ids past the end of the dimension ask for entities that do not exist.
CIKS = """
SELECT c_custkey AS cik FROM customer
UNION ALL SELECT c_custkey + 10000000 AS cik FROM customer WHERE c_custkey % 50 = 0
"""

FILINGS = """
SELECT o_custkey AS cik,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN '10-K'
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '10-K/A' ELSE '10-Q' END AS formType,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) END AS periodOfReport,
  concat(CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL '60' DAY AS DATE) AS VARCHAR(10)), 'T16:05:14') AS filedAt,
  concat(lpad(CAST(o_custkey AS VARCHAR(20)), 10, '0'), '-', substring(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 3, 2), '-',
         lpad(CAST(o_orderkey AS VARCHAR(20)), 9, '0')) AS accessionNo,
  concat('https://files.example/', CAST(o_orderkey AS VARCHAR(20)), '-index.htm') AS linkToHtml,
  o_orderkey AS src_pos
FROM orders
"""

WIDE_FACTS = """
SELECT o_custkey AS entitycentralindexkey, year(o_orderdate) AS documentfiscalyearfocus,
  concat('Company ', CAST(o_custkey AS VARCHAR(20))) AS entityregistrantname,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS start_date,
  CASE WHEN o_orderkey % 7 = 3 THEN NULL ELSE CAST(CAST(shipped AS DATE) AS VARCHAR(10)) END AS end_date,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(price AS DOUBLE) END AS SalesRevenueNet,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(price - 3000 * quantity AS DOUBLE) END AS NetIncomeLoss,
  CASE WHEN tax > 0 THEN CAST(tax AS DOUBLE) END AS ResearchAndDevelopmentExpense,
  o_orderkey AS src_pos
FROM orders JOIN (
  SELECT l_orderkey, max(l_shipdate) AS shipped, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS price,
    sum(CAST(l_quantity AS DECIMAL(18, 2))) AS quantity, sum(CAST(l_tax AS DECIMAL(18, 2))) AS tax
  FROM lineitem GROUP BY l_orderkey) AS lines ON l_orderkey = o_orderkey
"""

# One row per company and shifted year: the figures that statements print.
YEAR_FIGURES = """
SELECT cik, yr, revenue, rnd, CASE WHEN cik % 23 = 0 THEN 0 WHEN net BETWEEN -9 AND -1 THEN net - 10 ELSE net END AS net
FROM (SELECT o_custkey AS cik, year(o_orderdate) + 15 AS yr,
    CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18, 2)))) AS BIGINT) AS revenue,
    CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18, 2)))) AS BIGINT) % 10007 - 5000 AS net,
    count(*) * 1000 + o_custkey % 97 AS rnd
  FROM orders GROUP BY o_custkey, year(o_orderdate)) AS f
"""

# Companies and years to review.  Some rows lack the company, the year or the name.
REVIEW_YEARS = "(VALUES (2009), (2010), (2012), (2014), (2016), (2018)) AS t(y)"
REVIEW_ROWS = f"""
SELECT CASE WHEN c_custkey % 23 = 5 THEN NULL ELSE c_custkey END AS entitycentralindexkey,
  CASE WHEN (c_custkey + y) % 29 = 0 THEN NULL ELSE y END AS documentfiscalyearfocus,
  CASE WHEN c_custkey % 4 <> 0 THEN concat('Company ', CAST(c_custkey AS VARCHAR(20))) END AS entityregistrantname,
  c_custkey * 10000 + y AS src_pos
FROM customer CROSS JOIN {REVIEW_YEARS}
"""

# What the first tier knows of them: every fifth company.
REVIEW_FACTS = f"""
SELECT c_custkey AS entitycentralindexkey, y AS documentfiscalyearfocus, concat(CAST(y AS VARCHAR(4)), '-01-01') AS start_date,
  concat(CAST(y AS VARCHAR(4)), '-12-31') AS end_date, c_custkey * CAST(1.5 AS DOUBLE) AS SalesRevenueNet,
  c_custkey * CAST(1.5 AS DOUBLE) AS NetIncomeLoss, c_custkey * CAST(1.5 AS DOUBLE) AS ResearchAndDevelopmentExpense, c_custkey * 10000 + y AS src_pos
FROM customer CROSS JOIN {REVIEW_YEARS} WHERE c_custkey % 5 = 0
"""

SQL_INPUTS = {
    "entities": ENTITIES,
    "ciks": CIKS,
    "filings": FILINGS,
    "wide_facts": WIDE_FACTS,
    "year_figures": YEAR_FIGURES,
    "review_rows": REVIEW_ROWS,
    "review_facts": REVIEW_FACTS,
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

SWEEP_YEARS = (1995, 1996, 1998, 2000, 2001, 2003)
ASK_YEARS = (2009, 2010, 2012, 2014, 2016, 2018)
TASK_PAGES = 1000  # pages printed, and parsed, by one task: about 8 MB


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def given(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of ``SQL_INPUTS`` as a DataFrame."""
    text = SQL_INPUTS[name]
    used = {t: table(spark, sf, t) for t in TABLES if t in text}
    for t in used:
        text = _word(text, t)
    return spark.sql(text, **used)


def _word(text: str, name: str) -> str:
    import re

    return re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)


# --- statements -----------------------------------------------------------------


def document_url(cik) -> F.Column:
    return F.concat(F.lit("https://www.sec.gov/doc/"), cik.cast("string"), F.lit(".htm"))


def asked_url(cik) -> F.Column:
    """Address a request carries: every eleventh company is reached by an index page."""
    return F.when(
        cik % 11 == 0, F.concat(F.lit("https://www.sec.gov/doc/"), cik.cast("string"), F.lit("-index.htm"))
    ).otherwise(document_url(cik))


def _amount(n, footnote):
    text = F.format_number(F.abs(n), 0)
    return F.when(n < 0, F.concat(F.lit("("), text, F.lit(")"))).when(n == 0, "&#151;").otherwise(
        F.concat(text, footnote)
    )


def statement_pages(figures: DataFrame) -> DataFrame:
    """``cik, url, html, status``: one filing per company, printed from its figures.

    Latest year first.  By company number: the scale line, the wording of the
    revenue row, a missing research row, a short statement, no table at all, an
    error status.  All carry a cash-flow table, poison rows and a nested table.
    """
    years = F.sort_array(F.collect_list(F.struct("yr", "revenue", "net", "rnd")), asc=False)
    # The figures are small and would be read back as a few partitions; the pages
    # printed from them are not, so spread them first, so many pages to a task.
    companies = figures.agg(F.approx_count_distinct("cik")).first()[0]
    spread = max(2 * figures.sparkSession.sparkContext.defaultParallelism, -(-companies // TASK_PAGES))
    docs = figures.groupBy("cik").agg(years.alias("ys")).repartition(spread, "cik")
    cik = F.col("cik")

    def cells(pick, footnote=""):
        # Every figure sits between a currency cell and an empty styling cell.
        return F.array_join(
            F.transform(
                "ys",
                lambda y: F.concat(
                    F.lit("<td>$</td><td style=\"text-align:right\">"),
                    _amount(pick(y), F.lit(footnote)),
                    F.lit("</td><td>&nbsp;</td>"),
                ),
            ),
            "",
        )

    def row(label, body):
        return F.concat(F.lit("<tr><td><font size=2>"), label, F.lit("</font></td>"), body, F.lit("</tr>\n"))

    zero = F.lit("")
    scale = (
        F.when(cik % 3 == 0, "<tr><td>(In thousands, except per share data)</td></tr>")
        .when(cik % 3 == 1, "<tr><td>(in <b>millions</b>)</td></tr>")
        .otherwise("<tr><td>Amounts in dollars</td></tr>")
    )
    header = F.concat(
        F.lit("<tr><th>Fiscal year</th>"),
        F.array_join(
            F.transform("ys", lambda y: F.concat(F.lit("<th colspan=3>December 31,<br>"), y["yr"].cast("string"), F.lit("</th>"))), ""
        ),
        F.lit("</tr>"),
    )
    revenue_label = F.when(cik % 2 == 0, "Total revenues").otherwise("Net sales &amp; other")
    long_part = F.concat(
        row(F.lit("Cost of revenue"), cells(lambda y: y["revenue"] - 1)),
        row(revenue_label, cells(lambda y: y["revenue"])),
        F.when(cik % 7 == 0, zero).otherwise(
            row(F.lit("Research and development"), cells(lambda y: y["rnd"], "(a)"))
        ),
        row(F.lit("Purchased in-process research and development"), cells(lambda y: y["rnd"] + 1)),
        row(F.lit("Net income before taxes"), cells(lambda y: y["net"] + 7)),
        row(F.lit("Net (loss) income margin"), F.array_join(F.transform("ys", lambda y: F.lit("<td>12%</td>")), "")),
        row(F.lit("Net income (loss)"), cells(lambda y: y["net"])),
        row(F.lit("Net income (loss) per share"), cells(lambda y: y["net"] + 9)),
        row(F.lit("Weighted shares"), cells(lambda y: y["revenue"] + 3)),
    )
    statement = F.concat(
        F.lit("<table border=0><tr><td colspan=9>STATEMENTS OF OPERATIONS</td></tr>"),
        scale,
        header,
        F.lit("<tr><td><!-- <table> --></td></tr><tr><td><p>Year ended</p></td></tr>"),
        # The short form has too few rows to be taken for a statement.
        F.when(
            cik % 17 == 0, row(F.lit("Net income, total revenues"), cells(lambda y: y["net"]))
        ).otherwise(long_part),
        F.lit("</table>"),
    )
    cash = F.concat(
        F.lit("<table><tr><td>Cash flows from operations: net income, sales</td></tr>"),
        F.repeat(F.lit("<tr><td>Depreciation and amortisation of equipment</td><td>9,999,999</td></tr>"), 60),
        F.lit("</table>"),
    )
    layout = F.concat(F.lit("<table><tr><td>Contents<table><tr><td>Item 8</td></tr></table></td></tr></table>"))
    html = F.concat(
        F.lit("<html><head><style>td{margin:0}</style><script>var t='<table>';</script></head><body><p>Annual report of "),
        cik.cast("string"),
        F.lit("</p>"),
        F.when(cik % 13 == 0, "<p>Exhibits only. Net sales were steady.</p>").otherwise(F.concat(layout, statement, F.lit("<p>Notes</p>"), cash)),
        F.lit("<p>Signed</p></body></html>"),
    )
    return docs.select(
        "cik", document_url(cik).alias("url"), html.alias("html"), F.when(cik % 19 == 0, 404).otherwise(200).alias("status")
    )


def index_pages(pages: DataFrame) -> DataFrame:
    """Index pages for the companies whose requests carry one."""
    cik = F.col("cik")
    entry = lambda form, link: F.concat(
        F.lit("<tr><td>1</td><td>Main</td><td>"), link, F.lit("</td><td>"), F.lit(form), F.lit("</td></tr>")
    )
    html = F.concat(
        F.lit("<table><tr><th>Seq</th><th>Text</th><th>Document</th><th>10-K</th></tr>"),
        entry("EX-21", F.lit('<a href="/doc/none.htm">x</a>')),
        entry("10-K", F.lit("no link")),
        entry("10-K", F.concat(F.lit("<a class=k href='/doc/"), cik.cast("string"), F.lit(".htm'>doc</a>"))),
        F.lit("</table>"),
    )
    return pages.filter(cik % 11 == 0).select("cik", asked_url(cik).alias("url"), html.alias("html"), F.lit(200).alias("status"))


def filing_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot of all statements and index pages: ``url, html, status``.

    Written out once, as a landed snapshot would be, so that scans of addresses
    alone do not print the pages again.
    """
    from tiercast.plans.staging import stage

    pages = statement_pages(given(spark, sf, "year_figures"))
    both = pages.unionByName(index_pages(pages))
    return stage(both.select("url", "html", "status"), "landed")


def statement_requests(spark: SparkSession, sf: str) -> DataFrame:
    """``cik, year, metric_name, url``: each company, asked year and metric."""
    from tiercast.operators.requests import requests
    from tiercast.vocabulary import METRIC_COLUMNS

    asked = requests(table(spark, sf, "customer").select(F.col("c_custkey").alias("cik")), ASK_YEARS, METRIC_COLUMNS)
    return asked.withColumn("url", asked_url(F.col("cik")))


def review_filings(spark: SparkSession, sf: str) -> DataFrame:
    """Filing index over the rendered statements; every third company is not in it."""
    rows = given(spark, sf, "review_rows").select(F.floor(F.col("src_pos") / 10000).alias("cik"), (F.col("src_pos") % 10000).alias("y"), "src_pos")
    year = F.col("y").cast("string")
    return rows.filter("cik % 3 <> 1").select(
        "cik",
        F.lit("10-K").alias("formType"),
        F.concat(year, F.lit("-12-31")).alias("periodOfReport"),
        F.concat(year, F.lit("-12-31T16:05:14")).alias("filedAt"),
        F.concat_ws("-", F.col("cik"), year).alias("accessionNo"),
        asked_url(F.col("cik")).alias("linkToHtml"),
        "src_pos",
    )


# --- feeds and answers -------------------------------------------------------------


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    """``cik, recent``: one struct of parallel arrays per company, in order-key order.

    Report dates are shifted by 15 years; every 41st is missing.  Companies
    divisible by 29 have no feed, by 31 an empty one, by 37 ragged arrays.
    """
    o = table(spark, sf, "orders")
    date = F.date_format(F.add_months(F.col("o_orderdate").cast("date"), 180), "yyyy-MM-dd")
    filing = F.struct(
        F.col("o_orderkey"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "10-K").otherwise("10-Q").alias("form"),
        F.when(F.col("o_orderkey") % 41 != 0, date).alias("reportDate"),
        F.concat(
            F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.lit("-15-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
        ).alias("accessionNumber"),
        F.concat(F.lit("d"), F.col("o_orderkey").cast("string"), F.lit(".htm")).alias("primaryDocument"),
    )
    per = o.filter(F.col("o_custkey") % 29 != 0).groupBy(F.col("o_custkey").alias("cik")).agg(
        F.sort_array(F.collect_list(filing)).alias("f")
    )
    none = F.lit(None).cast("array<string>")
    live = F.col("cik") % 31 != 0
    field = lambda n: F.when(live, F.col(f"f.{n}")).otherwise(none).alias(n)
    ragged = F.when(live & (F.col("cik") % 37 == 0), F.slice(F.col("f.primaryDocument"), 1, 2)).when(
        live, F.col("f.primaryDocument")
    )
    return per.select(
        "cik",
        F.struct(field("form"), field("reportDate"), field("accessionNumber"), ragged.alias("primaryDocument")).alias("recent"),
    )


def model_answers(events: DataFrame) -> DataFrame:
    """``event_id, raw_response``: good and bad answers, by event number."""
    n = F.col("event_id")
    whole = F.floor(F.col("value") * 100).cast("string")
    obj = lambda found, dollars: F.concat(
        F.lit('{"line_item_found": "Net \\"sales\\"", "raw_reported_number": "1,2", "unit_scale": "exact", '),
        F.lit('"calculated_total_dollars": '), dollars, F.lit(', "metric_found": '), F.lit(found), F.lit("}"),
    )
    pick = (n % 16).cast("int")
    cases = [
        obj("true", whole),
        obj("false", whole),
        obj("true", F.lit("null")),
        F.lit("{bad"),
        obj("true", F.lit('"45,000"')),
        obj('"false"', whole),
        F.concat(obj("true", whole), F.lit(" trailing")),
        F.concat(F.lit("["), whole, F.lit("]")),
        obj("true", F.concat(F.lit("-"), whole, F.lit(".75"))),
        obj("true", F.concat(F.lit('"'), whole, F.lit('"'))),
        obj("0", whole),
        F.lit("  "),
        F.concat(F.lit("\n "), obj("1", whole), F.lit(" \n")),
        F.lit(None).cast("string"),
        F.lit('{"metric_found": true}'),
        obj("[]", whole),
    ]
    text = F.when(pick == 0, cases[0])
    for i, c in enumerate(cases[1:], start=1):
        text = text.when(pick == i, c)
    return events.select("event_id", text.alias("raw_response"))
