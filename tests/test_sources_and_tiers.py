"""Files in and out, first-tier rules, address recovery, sampling, the cascade's edges."""

import json

import pytest
from pyspark.sql import functions as F

from tiercast.operators.filings import with_filing
from tiercast.operators.landed import resolve
from tiercast.operators.results import render, split_value
from tiercast.operators.retrieve import nearest
from tiercast.operators.submissions import recover_urls
from tiercast.plans import cascade, tier1, verify
from tiercast.sources import documents as D
from tiercast.sources import tables as T
from tiercast.sources.catalogue import catalogue_columns, read_catalogue
from tiercast.sources.sinks import write_csv, write_parquet

METRICS = {"Rev": "Revenue", "Gone": "NoSuchColumn"}


def test_csv_keeps_file_order(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("cik,ticker,name\n" + "".join(f"{i % 7},T{i},N{i}\n" for i in range(20000)) + "x,N/A,\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = T.read_entities(spark, str(path)).orderBy("src_pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["ticker"] for r in rows] == [f"T{i}" for i in range(20000)] + [None]
    assert rows[-1]["cik"] == 0 and rows[-1]["name"] is None


def test_several_files_in_path_order(spark, tmp_path):
    for name, k in (("b.csv", 2), ("a.csv", 1)):
        (tmp_path / name).write_text(f"cik,ticker,name\n{k},t,n\n")
    rows = T.read_entities(spark, str(tmp_path)).orderBy("src_pos").collect()
    assert [r["cik"] for r in rows] == [1, 2]


def test_catalogue(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"A": {"xbrl_column": "ColA", "table_aliases": ["x", "y"]}, "B": {"xbrl_column": "ColB"}}, indent=1))
    cat = read_catalogue(spark, str(path))
    assert catalogue_columns(cat) == {"A": "ColA", "B": "ColB"}
    assert cat.filter("metric_name = 'A'").first()["table_aliases"] == ["x", "y"]


def test_headers(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "` CIK ` int, B int")
    assert T.lower_headers(df).columns == ["cik", "b"]
    with pytest.raises(ValueError):
        T.lower_headers(spark.createDataFrame([(1, 2)], "`a ` int, a int"))
    (tmp_path / "f.csv").write_text("EntityCentralIndexKey\n1\n")
    assert T.read_facts(spark, str(tmp_path / "none.csv"), str(tmp_path / "f.csv")).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        T.read_facts(spark, str(tmp_path / "none.csv"))


def facts(spark, tmp_path, rows, header="entitycentralindexkey,documentfiscalyearfocus,end_date,Revenue"):
    path = tmp_path / "facts.csv"
    path.write_text(header + "\n" + "\n".join(rows) + "\n")
    return T.read_csv(spark, str(path))


def sweep(spark, wide, ciks, years, filings=None):
    none = spark.createDataFrame([], "cik bigint, ticker string, name string, src_pos bigint")
    filings = filings or spark.createDataFrame(
        [], "cik bigint, formType string, periodOfReport string, filedAt string, accessionNo string, linkToHtml string, src_pos bigint"
    )
    out = tier1.sweep_list(spark, ciks, years, METRICS, none, filings, wide)
    return {(r["cik"], r["document_fiscal_year"], r["metric_name"]): r for r in out.collect()}


def test_fact_rules(spark, tmp_path):
    wide = facts(
        spark,
        tmp_path,
        [
            "1,2012,2012-12-31,12",
            "1,2014,2015-01-31,15",  # ends in 2015, fiscal year 2014
            "1,2014,,14",
            "1,2014,2015-02-28,16",
            "2,2010,2010-12-31,",
            "3,2010,,33",
            "4,2010,2010-12-31,abc",
        ],
    )
    got = sweep(spark, wide, [1, 2, 3, 4, 9], [2012, 2014, 2015, 2016])
    assert got[1, 2012, "Rev"]["extracted_value"] == 12
    assert got[1, 2015, "Rev"]["extracted_value"] == 15  # first in file order by end date
    assert got[1, 2014, "Rev"]["extracted_value"] == 16  # fiscal year: latest date, nulls last
    assert got[1, 2014, "Rev"]["metric_fiscal_year"] == 2015
    assert (got[1, 2016, "Rev"]["extracted_value"], got[1, 2016, "Rev"]["metric_fiscal_year"]) == (12, 2012)
    assert got[2, 2012, "Rev"]["winning_tier"] == "MISS"
    assert got[3, 2012, "Rev"]["period_end_date"] == "nan"
    assert got[3, 2012, "Rev"]["period_start_date"] == "UNKNOWN"
    assert got[4, 2012, "Rev"]["winning_tier"] == "MISS" and got[4, 2012, "Rev"]["audit_notes"]
    assert got[9, 2012, "Rev"]["company_name"] == "CIK_9" and got[9, 2012, "Rev"]["ticker"] == "N/A"
    assert all(r["winning_tier"] == "MISS" for k, r in got.items() if k[2] == "Gone")
    assert len(got) == 5 * 4 * 2


def test_no_date_column(spark, tmp_path):
    wide = facts(spark, tmp_path, ["1,2014,5", "1,2014,6"], "EntityCentralIndexKey,DocumentFiscalYearFocus,Revenue")
    got = sweep(spark, wide, [1], [2014])[1, 2014, "Rev"]
    assert (got["extracted_value"], got["period_end_date"], got["metric_fiscal_year"]) == (5, "UNKNOWN", 2014)


def test_filing_rules(spark):
    rows = [
        (1, "10-K/A", "2014-12-31", "2015-02-01", "amended", "u0", 0),
        (1, "10-K", None, "2015-03-01", "filed", "u1", 1),
        (1, "10-K", "2014-12-31", "2016-03-01", "period", None, 2),
        (2, "10-K", "2011-12-31", "20150302", "digits", "u3", 3),
    ]
    filings = spark.createDataFrame(
        rows, "cik bigint, formType string, periodOfReport string, filedAt string, accessionNo string, linkToHtml string, src_pos bigint"
    )
    reqs = spark.createDataFrame([(1, 2014), (1, 2015), (1, 2013), (2, 2014), (2, 1503), (1, 0), (3, 2014)], "cik bigint, year int")
    got = {(r["cik"], r["year"]): (r["accession_no"], r["edgar_url"]) for r in with_filing(reqs, filings).collect()}
    assert got[1, 2014] == ("period", "nan")
    assert got[1, 2015] == ("filed", "u1")
    assert got[1, 2013] == ("UNKNOWN", "UNKNOWN")
    assert got[2, 2014] == got[2, 1503] == ("digits", "u3")
    assert got[1, 0] == ("filed", "u1")
    assert got[3, 2014] == ("UNKNOWN", "UNKNOWN")


FEEDS = {
    1: {"form": ["10-Q", "10-K", "10-K"], "reportDate": ["2014-01-01", "2013-12-31", "2014-12-31"], "accessionNumber": ["a", "b", "0001-2"], "primaryDocument": ["d", "e", "f.htm"]},
    2: {},
    3: {"form": ["10-K", "10-K"], "reportDate": [None, "2014-12-31"], "accessionNumber": ["a", "b"], "primaryDocument": ["d", "e"]},
    4: {"form": ["10-K"], "reportDate": ["2014-12-31"], "accessionNumber": ["a"], "primaryDocument": []},
    5: {"form": []},
    6: {"form": ["10-K"], "reportDate": ["2014-12-31"], "accessionNumber": ["a"], "primaryDocument": [None]},
}


def test_address_recovery(spark, tmp_path):
    for cik, recent in FEEDS.items():
        (tmp_path / f"{cik}.json").write_text(json.dumps({"cik": str(cik).zfill(10), "filings": {"recent": recent}}, indent=1))
    feeds = D.read_submissions(spark, str(tmp_path))
    asked = spark.createDataFrame([(c, 2014) for c in [*FEEDS, 7]] + [(1, 2010), (1, 2010)], "cik bigint, year int")
    got = {(r["cik"], r["year"]): r["recovered_url"] for r in recover_urls(asked, feeds).collect()}
    root = "https://www.sec.gov/Archives/edgar/data"
    assert got == {
        (1, 2014): f"{root}/1/00012/f.htm",
        (1, 2010): "NO_FILING_EXISTS",
        (2, 2014): "NO_FILINGS_FOUND",
        (3, 2014): "API_ERROR",
        (4, 2014): "API_ERROR",
        (5, 2014): "NO_FILING_EXISTS",
        (6, 2014): f"{root}/6/a/None",
        (7, 2014): "API_ERROR",
    }


def test_documents_landed_twice_and_links(spark):
    rows = [("u", "b", 200), ("u", "a", 404), ("v", "", 200), ("w-index.htm", "<tr><td>1<td>2<td>3<td>10-K/A<a>x</a></tr>", 200)]
    docs = D.documents(spark.createDataFrame(rows, "url string, html string, status int"), status="status")
    assert D.one_per_url(docs).count() == 3
    urls = spark.createDataFrame([("u",), ("v",), ("w-index.htm",), ("x",)], "url string")
    # The link without an address fails; the page that never landed is absent.
    assert [tuple(r) for r in resolve(urls, docs).collect()] == [("u", "u")]


def test_section_source(spark):
    df = spark.createDataFrame([("u", '{"item_8": "<p>x</p>"}'), ("v", "{}")], "url string, body string")
    assert {r["url"]: r["html"] for r in D.section_documents(df, "body").collect()} == {"u": "<p>x</p>", "v": ""}


def test_results_round_trip(spark, tmp_path):
    wide = facts(spark, tmp_path, ["1,2014,2014-12-31,5"])
    none = spark.createDataFrame([], "cik bigint, ticker string, name string, src_pos bigint")
    filings = spark.createDataFrame(
        [], "cik bigint, formType string, periodOfReport string, filedAt string, accessionNo string, linkToHtml string, src_pos bigint"
    )
    out = tier1.sweep_list(spark, [1], [2014], METRICS, none, filings, wide)
    write_csv(render(out), str(tmp_path / "csv"))
    write_parquet(out, str(tmp_path / "pq"))
    back = T.read_results(spark, str(tmp_path / "csv"))
    assert back.columns == out.columns == spark.read.parquet(str(tmp_path / "pq")).columns
    rows = {r["metric_name"]: r for r in back.collect()}
    assert rows["Rev"]["extracted_value"] == 5 and rows["Gone"]["extracted_value"] is None
    mixed = spark.createDataFrame([("12.0",), ("YEAR_NOT_FOUND",), ("$12",), (None,)], "extracted_value string")
    assert [tuple(r) for r in split_value(mixed).collect()] == [
        (12.0, None, None),
        (None, None, "YEAR_NOT_FOUND"),
        (None, "$12", None),
        (None, None, None),
    ]


@pytest.mark.parametrize("rows_per_salt", [1_000_000, 7])
def test_nearest_is_exact_on_a_hot_collection(spark, rows_per_salt):
    pool = spark.range(3000).select(
        F.when(F.col("id") < 2900, 0).otherwise(F.col("id") % 5).cast("int").alias("c"),
        F.col("id").alias("chunk_idx"),
        F.array((F.col("id") * 7919 % 101).cast("float"), (F.col("id") * 104729 % 103).cast("float")).alias("embedding"),
    )
    q = spark.createDataFrame([(0, "a", [50.0, 50.0]), (0, "b", [0.0, 0.0]), (3, "a", [1.0, 2.0])], "c int, question string, q_embedding array<float>")
    got = {}
    for r in nearest(q, pool, "c", "question", rows_per_salt=rows_per_salt).orderBy("rank").collect():
        got.setdefault((r["c"], r["question"]), []).append(r["chunk_idx"])
    want = {}
    vectors = [(r["c"], r["chunk_idx"], r["embedding"]) for r in pool.collect()]
    for c, name, v in [(0, "a", (50, 50)), (0, "b", (0, 0)), (3, "a", (1, 2))]:
        ranked = sorted(((e[0] - v[0]) ** 2 + (e[1] - v[1]) ** 2, i) for k, i, e in vectors if k == c)
        want[c, name] = [i for _, i in ranked[:3]]
    assert got == want


def test_verification_rows_without_year_or_company(spark, tmp_path):
    wide = facts(
        spark,
        tmp_path,
        ["1,2014,2014-12-31,Acme", "1,2014,2014-12-31,Second", "2,,2014-12-31,Bee", ",2014,2014-12-31,"],
        "EntityCentralIndexKey, DocumentFiscalYearFocus ,end_date,EntityRegistrantName",
    )
    drawn = {(r["cik"], r["year"]): r["company_name"] for r in verify.draw(wide).collect()}
    assert drawn == {(1, 2014): "Acme", (2, None): "Bee", (None, 2014): "Company_UNKNOWN_CIK"}
    assert verify.draw(wide, n=2).count() == 2


def test_policies_differ_where_they_should():
    assert "YEAR_NOT_FOUND" not in cascade.BATCH.retry
    assert cascade.BATCH.failed is None and cascade.VERIFY.failed == "failed"
    assert cascade.VERIFY.url_first and not cascade.BATCH.url_first


def test_stage_uses_the_named_folder(spark):
    from tiercast.plans.staging import stage, stage_folder

    assert stage_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert stage(spark.range(3)).count() == 3


def test_empty_bodies_fail_the_download(spark):
    from tiercast.plans.tier2 import scrape

    rows = [("e", "", 200), ("x-index.htm", "", 200), ("p", "<p>no table</p>", 200), ("bad", "<table></table>", 404)]
    docs = D.documents(spark.createDataFrame(rows, "url string, html string, status int"), status="status")
    asked = spark.createDataFrame(
        [(u, "NetIncomeLoss", 2014) for u in ("e", "x-index.htm", "p", "bad", "gone", "UNKNOWN", None)],
        "url string, metric_name string, year int",
    )
    done = scrape(asked, docs, F.lit(True), F.col("url"), F.col("year"))
    got = {r["url"]: r["t2"]["status"] for r in done.collect()}
    assert got.pop("p") == "NO_TABLES"
    assert set(got.values()) == {"DOWNLOAD_FAILED"} and len(got) == 6


def test_loop_order(spark):
    """Company, then year, then catalogue order."""
    from tiercast.operators.results import in_loop_order

    rows = [(c, y, m) for m in ("b", "a", "c") for y in (2003, 2001) for c in (10, 9, 2)]
    df = spark.createDataFrame(rows, "cik long, document_fiscal_year int, metric_name string").repartition(4)
    got = [tuple(r) for r in in_loop_order(df, ["c", "a", "b"]).collect()]
    assert got == [(c, y, m) for c in (2, 9, 10) for y in (2001, 2003) for m in ("c", "a", "b")]


def test_overflowing_numbers_are_missing(spark, tmp_path):
    facts = spark.createDataFrame(
        [("inf", "2001", 1), ("1e300", "2001", 2), ("7", "1e300", 3), ("8", "2001", 4)],
        "entitycentralindexkey string, documentfiscalyearfocus string, src_pos int",
    )
    drawn = {(r.cik, r.year) for r in verify.draw(facts).collect()}
    assert drawn == {(None, 2001), (7, None), (8, 2001)}
    (tmp_path / "r.csv").write_text("cik,document_fiscal_year,extracted_value\n1e300,inf,5\n3,2001,6\n")
    got = {(r.cik, r.document_fiscal_year) for r in T.read_results(spark, str(tmp_path / "r.csv")).collect()}
    assert got == {(None, None), (3, 2001)}


def test_java_number_forms_are_no_numbers(spark):
    from tiercast.functions.numbers import fact_number

    got = spark.createDataFrame([("5f",), ("5d",), ("5",), ("1e3",), ("inf",), ("x",)], "v string").select(fact_number(F.col("v")).alias("v")).collect()
    assert [r.v for r in got] == [None, None, 5.0, 1000.0, float("inf"), None]


def test_landed_bodies_do_not_move(spark):
    """Pruning and parsing a landed snapshot exchange addresses, never HTML."""
    from tests.test_plans import plan_of
    from tiercast.operators import html as H
    from tiercast.operators.landed import wanted_documents

    docs = D.land(spark.range(50).selectExpr("concat('u', id) AS url", "concat('<p>', id, '</p>') AS html", "200 AS status"))
    urls = spark.range(0, 50, 7).selectExpr("concat('u', id) AS url")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parsed = H.parse(wanted_documents(docs, urls), "url")
        plan = plan_of(parsed)
        assert parsed.count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = plan.splitlines()
    above = []
    least = depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < least:
            least = depth(line)
            above.append(line)
    assert not any("Exchange" in line for line in above)
