"""HTML relations, statement look-up, Markdown and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as S
from tiercast.functions.numbers import cell_amount, clean_cell, is_number_cell
from tiercast.operators import html as H
from tiercast.operators.landed import dealt, resolve
from tiercast.operators.statement import statements
from tiercast.plans.tier2 import scrape


def _filings(spark, sf):
    return H.parse(S.statement_pages(S.given(spark, sf, "year_figures")).select("cik", "html"), "cik")


# What each printed document must hold, from the figures alone.
CELLS = f"""
figures AS ({S.YEAR_FIGURES}),
placed AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY yr DESC) - 1 AS i FROM figures),
docs AS (SELECT cik, count(*) AS ny FROM figures GROUP BY cik),
tabled AS (SELECT * FROM docs WHERE cik % 13 <> 0),
lines AS (
  SELECT cik, ny, 5 - 1 + row_number() OVER (PARTITION BY cik ORDER BY ord) AS row_idx, label, kind FROM (
    SELECT cik, ny, u.* FROM tabled, (VALUES (1, 'Cost of revenue', 'r-'), (2, '', 'r'), (3, 'Research and development', 'd(a)'),
      (4, 'Purchased in-process research and development', 'd+'), (5, 'Net income before taxes', 'n+7'),
      (6, 'Net (loss) income margin', '%'), (7, 'Net income (loss)', 'n'), (8, 'Net income (loss) per share', 'n+9'),
      (9, 'Weighted shares', 'r+3')) AS u(ord, label, kind) WHERE cik % 17 <> 0 AND NOT (ord = 3 AND cik % 7 = 0)
    UNION ALL SELECT cik, ny, 7, 'Net income, total revenues', 'n' FROM tabled WHERE cik % 17 = 0)),
named AS (SELECT * REPLACE (CASE WHEN kind = 'r' THEN CASE WHEN cik % 2 = 0 THEN 'Total revenues' ELSE 'Net sales & other' END ELSE label END AS label) FROM lines),
amounts AS (
  SELECT l.cik, row_idx, i, kind, CASE kind WHEN 'r-' THEN revenue - 1 WHEN 'r' THEN revenue WHEN 'r+3' THEN revenue + 3
      WHEN 'd(a)' THEN rnd WHEN 'd+' THEN rnd + 1 WHEN 'n' THEN net WHEN 'n+7' THEN net + 7 WHEN 'n+9' THEN net + 9 END AS v
  FROM named l JOIN placed p ON p.cik = l.cik),
printed AS (SELECT *, CASE WHEN kind = '%' THEN '12%' WHEN v < 0 THEN '(' || format('{{:,}}', -v) || ')' WHEN v = 0 THEN '—'
      ELSE format('{{:,}}', v) || CASE WHEN kind = 'd(a)' THEN '(a)' ELSE '' END END AS text FROM amounts),
statement AS (
  SELECT cik, row_idx, 0 AS cell_idx, true AS is_data, label AS text FROM named
  UNION ALL SELECT cik, row_idx, 3 * i + 1, true, '$' FROM printed WHERE kind <> '%'
  UNION ALL SELECT cik, row_idx, CASE WHEN kind = '%' THEN i + 1 ELSE 3 * i + 2 END, true, text FROM printed
  UNION ALL SELECT cik, row_idx, 3 * i + 3, true, '' FROM printed WHERE kind <> '%'
  UNION ALL SELECT cik, 0, 0, true, 'STATEMENTS OF OPERATIONS' FROM tabled
  UNION ALL SELECT cik, 1, 0, true, CASE cik % 3 WHEN 0 THEN '(In thousands, except per share data)' WHEN 1 THEN '(in millions )' ELSE 'Amounts in dollars' END FROM tabled
  UNION ALL SELECT cik, 2, 0, false, 'Fiscal year' FROM tabled
  UNION ALL SELECT t.cik, 2, i + 1, false, 'December 31, ' || yr FROM tabled t JOIN placed p ON p.cik = t.cik
  UNION ALL SELECT cik, 3, 0, true, '' FROM tabled
  UNION ALL SELECT cik, 4, 0, true, 'Year ended' FROM tabled),
cells AS (
  SELECT cik, 2 AS table_idx, * EXCLUDE (cik) FROM statement
  UNION ALL SELECT cik, u.* FROM tabled, (VALUES (0, 0, 0, true, 'Contents Item 8'), (0, 0, 1, true, 'Item 8'), (0, 1, 0, true, 'Item 8'), (1, 0, 0, true, 'Item 8'),
      (3, 0, 0, true, 'Cash flows from operations: net income, sales')) AS u(table_idx, row_idx, cell_idx, is_data, text)
  UNION ALL SELECT cik, 3, r, c, true, CASE c WHEN 0 THEN 'Depreciation and amortisation of equipment' ELSE '9,999,999' END
    FROM tabled, (SELECT unnest(range(1, 61)) AS r), (SELECT unnest([0, 1]) AS c))
"""

_MD = f"""
{CELLS},
wide AS (SELECT cik, table_idx, max(n) AS width FROM (SELECT cik, table_idx, row_idx, count(*) AS n FROM cells GROUP BY ALL) GROUP BY ALL),
row_lists AS (SELECT cik, table_idx, row_idx, width, list(text ORDER BY cell_idx) AS texts FROM cells JOIN wide USING (cik, table_idx) GROUP BY cik, table_idx, row_idx, width),
md_rows AS (SELECT cik, table_idx, row_idx, width, '| ' || array_to_string(list_resize(texts, width, ''), ' | ') || ' |' AS line FROM row_lists),
grids AS (SELECT cik, table_idx, width, string_agg(line || CASE WHEN row_idx = 0 THEN chr(10) || '|' || repeat('---|', width) ELSE '' END, chr(10) ORDER BY row_idx) AS markdown
  FROM md_rows GROUP BY cik, table_idx, width)
"""


def html_tables(spark, sf):
    return H.tables(_filings(spark, sf), "cik").drop("text")


HTML_TABLES = f"""
WITH {CELLS}
SELECT cik, table_idx, CASE WHEN table_idx = 1 THEN 2 ELSE 1 END AS depth, count(DISTINCT row_idx) AS n_rows FROM cells GROUP BY ALL
"""


def html_rows(spark, sf):
    return H.rows(_filings(spark, sf), "cik")


# Outer rows repeat nested text once in their own text, so only their cells do so twice.
HTML_ROWS = f"""
WITH {CELLS}
SELECT cik, table_idx, row_idx, count(*) AS n_cells,
  CASE WHEN table_idx = 0 AND row_idx = 0 THEN 'Contents Item 8' ELSE coalesce(string_agg(text, ' ' ORDER BY cell_idx) FILTER (WHERE text <> ''), '') END AS text
FROM cells GROUP BY cik, table_idx, row_idx
"""


def html_cells(spark, sf):
    return H.cells(_filings(spark, sf), "cik").drop("joined")


HTML_CELLS = f"WITH {CELLS} SELECT cik, table_idx, row_idx, cell_idx, is_data, text FROM cells"


def table_markdown(spark, sf):
    return H.markdown(_filings(spark, sf), "cik")


TABLE_MARKDOWN = f"WITH {_MD} SELECT cik, table_idx, width, markdown FROM grids"


def filing_text(spark, sf):
    return H.plain_text(_filings(spark, sf), "cik")


FILING_TEXT_CTE = f"""
{_MD},
texts AS (SELECT d.cik, regexp_replace(CASE WHEN d.cik % 13 = 0 THEN 'Annual report of ' || d.cik || ' Exhibits only. Net sales were steady. Signed'
  ELSE 'Annual report of ' || d.cik || ' ' || a.markdown || ' ' || b.markdown || ' Notes ' || c.markdown || ' Signed' END, '[ \\t]+', ' ', 'g') AS text
FROM docs d LEFT JOIN grids a ON a.cik = d.cik AND a.table_idx = 0 LEFT JOIN grids b ON b.cik = d.cik AND b.table_idx = 2
LEFT JOIN grids c ON c.cik = d.cik AND c.table_idx = 3)
"""
FILING_TEXT = f"WITH {FILING_TEXT_CTE} SELECT cik, text FROM texts"


def statement_pick(spark, sf):
    return statements(_filings(spark, sf), "cik").drop("header", "body")


STATEMENT_PICK = f"""
WITH figures AS ({S.YEAR_FIGURES})
SELECT cik, CASE WHEN cik % 13 = 0 THEN 0 ELSE 4 END AS n_tables,
  CASE WHEN cik % 13 = 0 OR cik % 17 = 0 THEN 0 ELSE 1 END AS n_candidates,
  CASE WHEN cik % 13 = 0 OR cik % 17 = 0 THEN NULL ELSE 2 END AS table_idx
FROM (SELECT DISTINCT cik FROM figures)
"""

# Where a request's value must come from, from the figures alone.
TIER2_CTE = f"""
figures AS ({S.YEAR_FIGURES}),
metrics(metric_name) AS (VALUES ('ResearchAndDevelopment'), ('SalesRevenueNet'), ('NetIncomeLoss')),
reqs AS (SELECT c_custkey AS cik, y AS year, metric_name FROM customer, metrics, (SELECT unnest({list(S.ASK_YEARS)}) AS y)),
located AS (SELECT r.*, (SELECT count(*) FROM figures f WHERE f.cik = r.cik) AS ny,
    coalesce(t.yr, n.yr) AS hit_yr, coalesce(t.revenue, n.revenue) AS revenue, coalesce(t.net, n.net) AS net, coalesce(t.rnd, n.rnd) AS rnd
  FROM reqs r LEFT JOIN figures t ON t.cik = r.cik AND t.yr = r.year LEFT JOIN figures n ON n.cik = r.cik AND n.yr = r.year + 1),
scraped AS (SELECT cik, year, metric_name, hit_yr,
    CASE WHEN ny = 0 OR (cik % 19 = 0 AND cik % 11 <> 0) THEN 'DOWNLOAD_FAILED'
         WHEN cik % 13 = 0 THEN 'NO_TABLES' WHEN cik % 17 = 0 THEN 'TABLE_NOT_FOUND'
         WHEN hit_yr IS NULL THEN 'YEAR_NOT_FOUND'
         WHEN metric_name = 'ResearchAndDevelopment' AND cik % 7 = 0 THEN 'METRIC_ROW_NOT_FOUND' END AS status,
    CASE metric_name WHEN 'SalesRevenueNet' THEN revenue WHEN 'NetIncomeLoss' THEN net ELSE rnd END
      * CASE cik % 3 WHEN 0 THEN 1000 WHEN 1 THEN 1000000 ELSE 1 END AS v
  FROM located),
tier2 AS (SELECT cik, year, metric_name, CASE WHEN status IS NULL THEN CAST(v AS DOUBLE) END AS amount, status,
    coalesce(status NOT IN ('DOWNLOAD_FAILED', 'NO_TABLES', 'TABLE_NOT_FOUND'), true) AS has_statement FROM scraped)
"""


def tier2_values(spark, sf):
    reqs = S.statement_requests(spark, sf)
    docs = S.filing_documents(spark, sf)
    done = scrape(reqs, docs, F.lit(True), F.col("url"), F.col("year"), unique=True)
    return done.select("cik", "year", "metric_name", "t2.amount", "t2.status", "t2.has_statement", F.col("t2.raw_value").alias("raw_value"))


TIER2_VALUES = f"WITH {TIER2_CTE} SELECT *, CAST(NULL AS VARCHAR) AS raw_value FROM tier2"


def _looked_up(spark, sf):
    from tiercast.operators.statement import lookup

    read = statements(_filings(spark, sf), "cik").filter(F.col("table_idx").isNotNull())
    # Planned sizes know nothing of the rows unfolded from each company, so requests would be broadcast.
    return lookup(S.statement_requests(spark, sf).hint("merge").join(read, "cik"))


def year_column(spark, sf):
    return _looked_up(spark, sf).select("cik", "year", "metric_name", "year_row", "year_idx")


_PLACED = f"""
{TIER2_CTE},
order_in AS (SELECT cik, yr, row_number() OVER (PARTITION BY cik ORDER BY yr DESC) - 1 AS i FROM figures),
listed AS (SELECT l.*, i FROM located l LEFT JOIN order_in o ON o.cik = l.cik AND o.yr = hit_yr WHERE ny > 0 AND l.cik % 13 <> 0 AND l.cik % 17 <> 0)
"""
YEAR_COLUMN = f"WITH {_PLACED} SELECT cik, year, metric_name, CASE WHEN i IS NULL THEN NULL ELSE 2 END AS year_row, CAST(i AS INTEGER) AS year_idx FROM listed"


def scale_carry(spark, sf):
    return _looked_up(spark, sf).groupBy("cik", "scale").agg(F.count(F.lit(1)).alias("n"))


SCALE_CARRY = f"""
WITH {_PLACED} SELECT cik, CASE WHEN i IS NULL THEN NULL WHEN cik % 3 = 0 THEN 1000.0 WHEN cik % 3 = 1 THEN 1000000.0 ELSE 1.0 END::DOUBLE AS scale, count(*) AS n
FROM listed GROUP BY ALL
"""


def index_hop(spark, sf):
    asked = S.statement_requests(spark, sf).select("url").distinct()
    return resolve(asked, S.filing_documents(spark, sf), unique=True)


INDEX_HOP = f"""
WITH figures AS ({S.YEAR_FIGURES})
SELECT 'https://www.sec.gov/doc/' || cik || CASE WHEN cik % 11 = 0 THEN '-index.htm' ELSE '.htm' END AS url,
  'https://www.sec.gov/doc/' || cik || '.htm' AS content_url
FROM (SELECT DISTINCT cik FROM figures) WHERE cik % 11 = 0 OR cik % 19 <> 0
"""


def cell_numbers(spark, sf):
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    k = F.col("o_orderkey") % 13
    whole = F.format_number(F.floor("o_totalprice"), 0)
    shapes = [
        whole,
        F.concat(F.lit("("), whole, F.lit(")")),
        F.concat(F.lit("-"), whole),
        F.lit(" — "),
        F.concat(whole, F.lit("(a)")),
        F.concat(F.lit("$"), whole),
        F.concat(F.lit("("), whole),
        F.lit("12%"),
        F.concat(whole, F.lit("f")),
        F.format_number("o_totalprice", 2),
        F.concat(F.lit("(-"), whole, F.lit(")")),
        F.lit("n/m"),
        F.concat(F.lit(" "), whole, F.lit(" ")),
    ]
    cell = F.when(k == 0, shapes[0])
    for i, shape in enumerate(shapes[1:], start=1):
        cell = cell.when(k == i, shape)
    scale = F.element_at(F.array(F.lit(1.0), F.lit(1000.0), F.lit(1000000.0)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    cleaned = o.withColumn("cell", clean_cell(cell)).withColumn("is_number", is_number_cell(F.col("cell")))
    amount = F.when(F.col("is_number"), cell_amount(F.col("cell"), scale))
    return cleaned.select(
        "o_orderkey",
        "is_number",
        amount.alias("amount"),
        F.when(F.col("is_number") & amount.isNull(), F.col("cell")).alias("raw_value"),
    )


CELL_NUMBERS = """
WITH o AS (SELECT o_orderkey, o_orderkey % 13 AS k, CAST(floor(o_totalprice) AS BIGINT) AS n, o_totalprice AS p,
  CAST([1, 1000, 1000000][o_orderkey % 3 + 1] AS BIGINT) AS s FROM orders)
SELECT o_orderkey, k NOT IN (7, 11) AS is_number,
  CASE WHEN k IN (0, 4, 10, 12) THEN n * s WHEN k IN (1, 2) THEN -n * s WHEN k = 3 THEN 0 WHEN k = 9 THEN CAST(trunc(p * s) AS BIGINT) END AS amount,
  CASE k WHEN 5 THEN '$' || n WHEN 6 THEN '(' || n WHEN 8 THEN n || 'f' END AS raw_value
FROM o
"""


# --- raw pages --------------------------------------------------------------------


def page_tags(spark, sf):
    pages = S.table(spark, sf, "pages")
    tags = pages.select("page_id", F.explode(H.tokens(F.col("html"))).alias("token")).select(
        "page_id", H.token_tag(F.col("token")).alias("tag")
    )
    return tags.filter(F.col("tag") != "").groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


# Scripts and styles are one token each, under their opening tag.
PAGE_TAGS = r"""
SELECT page_id, tag, count(*) AS n FROM (
  SELECT page_id, unnest(list_transform(regexp_extract_all(
    regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)<(script|style)[^>]*>.*?</(script|style)>', '<\1>', 'g'),
    '<(/?[a-zA-Z][^\s/>]*)[^>]*>', 1), lambda x: lower(x))) AS tag FROM pages) GROUP BY ALL
"""


def page_links(spark, sf):
    links = S.table(spark, sf, "pages").select("page_id", F.posexplode(H.anchors(F.col("html"))).alias("link_idx", "a"))
    return links.select("page_id", "link_idx", "a.href")


PAGE_LINKS = """
SELECT page_id, i - 1 AS link_idx, replace(replace(hrefs[i], '&quot;', '"'), '&amp;', '&') AS href
FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages), unnest(range(1, len(hrefs) + 1)) AS t(i)
"""


def page_text(spark, sf):
    pages = dealt(S.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return H.plain_text(H.parse(pages, "page_id"), "page_id")


PAGE_TEXT_CTE = r"""
page_texts AS (SELECT page_id, regexp_replace(regexp_replace(array_to_string(list_filter(list_transform(
    regexp_split_to_array(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<[a-z/!][^>]*>'),
    lambda x: trim(replace(replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), chr(160), ' '), E' \t\n\r')),
    lambda x: x <> ''), ' '), '[ \t]+', ' ', 'g'), '\n\s*\n', E'\n\n', 'g') AS text FROM pages)
"""
PAGE_TEXT = f"WITH {PAGE_TEXT_CTE} SELECT page_id, text FROM page_texts"

QUERIES = {
    "html_tables": html_tables,
    "html_rows": html_rows,
    "html_cells": html_cells,
    "table_markdown": table_markdown,
    "filing_text": filing_text,
    "statement_pick": statement_pick,
    "year_column": year_column,
    "scale_carry": scale_carry,
    "tier2_values": tier2_values,
    "index_hop": index_hop,
    "cell_numbers": cell_numbers,
    "page_tags": page_tags,
    "page_links": page_links,
    "page_text": page_text,
}
ORACLES = {
    "html_tables": HTML_TABLES,
    "html_rows": HTML_ROWS,
    "html_cells": HTML_CELLS,
    "table_markdown": TABLE_MARKDOWN,
    "filing_text": FILING_TEXT,
    "statement_pick": STATEMENT_PICK,
    "year_column": YEAR_COLUMN,
    "scale_carry": SCALE_CARRY,
    "tier2_values": TIER2_VALUES,
    "index_hop": INDEX_HOP,
    "cell_numbers": CELL_NUMBERS,
    "page_tags": PAGE_TAGS,
    "page_links": PAGE_LINKS,
    "page_text": PAGE_TEXT,
}
