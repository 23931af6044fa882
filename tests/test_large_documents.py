"""Documents as large as real filings, and markup that does not close."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tests.test_plans import plan_of
from tiercast.operators import html as H


def filing(rows: int) -> str:
    return "<table>" + "".join(f"<tr><td>Row {i}</td><td>{i}</td></tr>" for i in range(rows)) + "</table>"


def test_memory_is_linear_in_one_document(spark):
    """Megabytes in one value; with the text beside every event this took gigabytes at a tenth of the size."""
    docs = spark.createDataFrame([(1, filing(40_000)), (2, filing(130_000))], "k int, html string")
    got = {r.k: r for r in H.parse(docs, "k").select("k", F.size("rows").alias("rows"), F.size("cells").alias("cells"), F.size("pieces").alias("pieces")).collect()}
    for k, n in ((1, 40_000), (2, 130_000)):
        assert (got[k].rows, got[k].cells, got[k].pieces) == (n, 2 * n, 2 * n)


def test_unfolding_carries_the_key_only(spark):
    docs = spark.createDataFrame([(1, "<p>a</p>")], "k int, html string")
    generate = [line for line in plan_of(H.parse(docs, "k")).splitlines() if "Generate posexplode" in line]
    assert len(generate) == 1 and "[k#" in generate[0] and "text#" not in generate[0]


def test_windows_carry_counts_and_no_cells(spark):
    docs = spark.createDataFrame([(1, "<table><tr><td>a</td></tr></table>")], "k int, html string")
    lines = plan_of(H.parse(docs, "k")).splitlines()
    unfolded = next(i for i, line in enumerate(lines) if "Generate posexplode" in line)
    grouped = max(i for i, line in enumerate(lines[:unfolded]) if "Aggregate" in line)
    over = lines[grouped + 1 : unfolded]
    assert any("Window" in line for line in over) and not any("cells#" in line for line in over)


def test_unclosed_comments_take_linear_time(spark):
    bodies = [(1, "<!--" * 100_000), (2, "<p>a</p>" + "<!-- x > y " * 100_000), (3, "<!-- a --><p>b</p><!-- c")]
    docs = spark.createDataFrame(bodies, "k int, html string")
    start = time.perf_counter()
    got = {r.k: r.pieces for r in H.parse(docs, "k").select("k", "pieces").collect()}
    counts = {r.k: r.n for r in docs.select("k", F.size(H.tokens(F.col("html"))).alias("n")).collect()}
    assert time.perf_counter() - start < 60
    assert got[1] == ["<!--" * 100_000]
    assert got[2][0] == "a" and set(got[2][1:]) == {"y"}
    assert got[3] == ["b", "<!-- c"]
    assert counts[3] == 5


def test_parts_and_cells_are_read_as_letters(spark):
    """Lists of structs per part and cell, made and copied in step after step, were most of the time."""
    docs = spark.createDataFrame([(1, "<table><tr><td>a</td></tr></table>")], "k int, html string")
    lines = plan_of(H.parse(docs, "k")).splitlines()
    unfolded = next(i for i, line in enumerate(lines) if "Generate posexplode" in line)
    before = "\n".join(lines[unfolded:])
    assert "shape" in before and "tag" not in before and "pieces" not in before


def test_tasks_hold_few_pages(spark):
    """Four thousand pages a task took 285 MB of execution memory; it is a fixed amount of markup now."""
    from checks import standins
    from tiercast.operators import landed

    assert landed.TASK_BYTES <= 8 << 20 and standins.TASK_PAGES <= 1000


def test_shape_of_odd_markup(spark):
    bodies = [
        (1, "<<tr><TD>a<b>b</b></TD ><th>c&#4;&#5;<td >d"),
        (2, "x<table><tr ><td>\x05 a\x04</td> <table><td>&amp;&nbsp;</table>q</tr></table>r"),
        (3, "</tr><table>t</table></tr><table"),
        (4, ""),
    ]
    docs = spark.createDataFrame(bodies, "k int, html string")
    got = {r.k: r for r in H.parse(docs, "k").collect()}
    cells = {k: [(c.is_data, c.piece_lo, c.piece_hi) for c in r.cells] for k, r in got.items()}
    assert got[1].pieces == ["<", "a", "b", "c\x04\x05", "d"]
    assert cells[1] == [(True, 1, 3), (False, 3, 4), (True, 4, 5)]
    assert got[2].pieces == ["x", "\x05 a\x04", "&", "q", "r"]
    assert cells[2] == [(True, 1, 2), (True, 2, 3)]
    assert [(t.depth, t.piece_lo, t.piece_hi) for t in got[2].tables] == [(1, 1, 4), (2, 2, 3)]
    assert got[3].pieces == ["t", "<table"] and [t.piece_hi for t in got[3].tables] == [1]
    assert (got[4].pieces, got[4].tables, got[4].rows, got[4].cells) == ([], [], [], [])
