"""HTML relations and statement look-up on hand-written documents."""

import pytest
from pyspark.sql import functions as F

from tiercast.operators import html as H
from tiercast.operators.statement import lookup, statements

NESTED = (
    '<p>hi &amp; <b>x</b> a < b</p><table><caption>Cap</caption><tr><td>A&#151;</td><th title="<td>">B<br>C</th></tr>'
    "<tr><td>outer<table><tr><td>n1<td>n2</tr><tr><td>n3</td></tr></table>tail</td><td/><td>z&nbsp;</td></tr></table>"
    " after <!-- <table> --> <table><tr></table>end"
)


def parsed(spark, *docs):
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "k string, html string")
    return H.parse(df, "k", links=True)


def test_nested_tables(spark):
    p = parsed(spark, NESTED).cache()
    tables = [(r["depth"], r["n_rows"], r["text"]) for r in H.tables(p, "k").orderBy("table_idx").collect()]
    assert tables == [(1, 4, "Cap A— B C outer n1 n2 n3 tail z"), (2, 2, "n1 n2 n3"), (1, 1, "")]
    rows = {(r["table_idx"], r["row_idx"]): (r["n_cells"], r["text"]) for r in H.rows(p, "k").collect()}
    assert rows[(0, 1)] == (6, "outer n1 n2 n3 tail z")
    assert rows[(0, 2)] == rows[(1, 0)] == (2, "n1 n2")
    cells = [r["joined"] for r in H.cells(p, "k").filter("table_idx = 0 AND row_idx = 1").orderBy("cell_idx").collect()]
    assert cells == ["outern1n2n3tail", "n1", "n2", "n3", "", "z"]
    text = H.plain_text(p, "k").first()["text"]
    assert text.startswith("hi & x a < b | A— | B C | | | | |\n|---|---|---|---|---|---|\n| outer n1")
    assert text.endswith("| n3 | | | | | | after end")


def test_deep_nesting_has_no_limit(spark):
    depth = 40
    doc = "<table><tr><td>x" * depth + "</td></tr></table>" * depth
    rows = H.tables(parsed(spark, doc), "k").orderBy("table_idx").collect()
    assert [(r["depth"], r["n_rows"], r["text"]) for r in rows] == [
        (i + 1, depth - i, " ".join("x" * (depth - i))) for i in range(depth)
    ]


def test_malformed(spark):
    docs = [
        "</table></table><tr><td>q<a href=\"/x.htm\">l</a><a>n</a></td></tr><table><tr><td>1",
        "",
        "no tables",
        "<table><tr><td>a</td></tr><table><tr><td>b</td></tr></table><tr><td>c",
        "<table><tr><td>a</td> tail <td>b</table>x<script>var a='<table><tr>'",
    ]
    p = parsed(spark, *docs).cache()
    got = {}
    for r in H.cells(p, "k").orderBy("table_idx", "row_idx", "cell_idx").collect():
        got.setdefault(r["k"], []).append((r["table_idx"], r["row_idx"], r["text"]))
    assert got["0"] == [(0, 0, "1")]
    assert got["3"] == [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "b")]
    assert got["4"] == [(0, 0, "a"), (0, 0, "b")]
    assert set(got) == {"0", "3", "4"}
    assert p.count() == 5
    assert {r["k"]: r["text"] for r in H.plain_text(p, "k").collect()}["1"] == ""


def test_ragged_markdown(spark):
    doc = "<table><tr><td>a</td></tr><tr><td>1</td><td>2<br>\n3</td><th>4</th></tr></table>"
    assert H.markdown(parsed(spark, doc), "k").first()["markdown"] == "| a |  |  |\n|---|---|---|\n| 1 | 2 3 | 4 |"


def statement(header, rows, scale="(in thousands)"):
    cells = lambda r: "".join(f"<td>{c}</td>" for c in r)
    head = [["Statement"], [scale], header, [""], [""]]
    filler = [["Net income and sales filler row", "1", "2"]] * 8
    return "<table>" + "".join(f"<tr>{cells(r)}</tr>" for r in head + rows + filler) + "</table>"


def ask(spark, doc, metric, year):
    read = statements(parsed(spark, doc), "k")
    row = lookup(read.withColumn("metric_name", F.lit(metric)).withColumn("year", F.lit(year))).first()
    return row["status"] or row["raw_value"] or row["amount"]


@pytest.mark.parametrize(
    "header,rows,metric,year,want",
    [
        (["2016", "2015"], [["Total revenues", "10", "20"]], "SalesRevenueNet", 2015, 20000),
        (["2016", "2014"], [["Total revenues", "10", "20"]], "SalesRevenueNet", 2015, 10000),
        (["2009", "2008"], [["Total revenues", "10", "20"]], "SalesRevenueNet", 2009, "YEAR_NOT_FOUND"),
        (["2016"], [["Goodwill", "7"]], "Goodwill", 2016, 7000),
        (["2016"], [["Net income per share", "7"], ["Net loss", "(8,000)"]], "NetIncomeLoss", 2016, -8000000),
        (["2016", "2015"], [["Net sales", "5"], ["Other sales", "6", "7"]], "SalesRevenueNet", 2015, 7000),
        (["2016", "2015"], [["Net sales", "(5)", "6", "7"]], "SalesRevenueNet", 2015, 7000),
        (["2016"], [["Net sales", "$12"]], "SalesRevenueNet", 2016, "$12"),
        (["2016"], [["Something", "1"]], "ResearchAndDevelopment", 2016, "METRIC_ROW_NOT_FOUND"),
    ],
)
def test_lookup(spark, header, rows, metric, year, want):
    assert ask(spark, statement(header, rows), metric, year) == want


def test_scale_order_within_a_row(spark):
    doc = statement(["2016"], [["Net sales", "3"]], scale="in millions; shares in thousands")
    assert ask(spark, doc, "SalesRevenueNet", 2016) == 3000000


def test_longest_statement_wins_first_on_ties(spark):
    one = statement(["2016"], [["Net sales", "1"]])
    read = statements(parsed(spark, one + one, "<table><tr><td>net income sales</td></tr></table>" + one), "k")
    assert [r["table_idx"] for r in read.orderBy("k").collect()] == [0, 1]


def test_characters_that_serve_as_marks_stay_text(spark):
    doc = "<table><tr><td>a\x01b\x02</td><td>\x03 c\x06a</td></tr>\x04<tr><td>\x05</td></tr></table>\x06"
    p = parsed(spark, doc).cache()
    assert [r["text"] for r in H.cells(p, "k").orderBy("row_idx", "cell_idx").collect()] == ["a\x01b\x02", "\x03 c\x06a", "\x05"]
    assert p.first()["pieces"] == ["a\x01b\x02", "\x03 c\x06a", "\x04", "\x05", "\x06"]


def test_tags_that_never_end_and_closing_tags_with_spaces(spark):
    docs = ["<tr><td>a</td ><td>b</td x>c<td>d</TD></tr><tr><td>e <table f", "<tr><td>a<table></table></td> b<td>c", "<script>x</script><tr><td>q <td r"]
    got = {r["k"]: r for r in parsed(spark, *docs).collect()}
    cells = {k: [(c["piece_lo"], c["piece_hi"]) for c in r["cells"]] for k, r in got.items()}
    assert got["0"]["pieces"] == ["a", "b", "c", "d", "e", "table f"]
    assert cells["0"] == [(0, 1), (1, 2), (3, 4), (4, 6)]
    assert got["1"]["pieces"] == ["a", "b", "c"] and cells["1"] == [(0, 1), (2, 3)]
    assert got["2"]["pieces"] == ["q", "td r"] and cells["2"] == [(0, 1)]
