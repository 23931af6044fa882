"""Literal edge cases of numbers, keys, entities, chunks and answers."""

import pytest
from pyspark.sql import functions as F

from tiercast.functions.links import archive_url, bare_cik, pad_cik
from tiercast.functions.numbers import cell_amount, clean_cell, coerce_key, is_number_cell, parse_year, render_double
from tiercast.functions.text import decode_entities, strip, words
from tiercast.operators.chunks import chunks
from tiercast.operators.prompts import parse_answer


def values(spark, items, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v")).alias("x")).collect()]


CELLS = [
    ("(1,234)", 1000.0, True, -1234000),
    ("—", 1000.0, True, 0),
    ("-", 1.0, True, 0),
    ("1,234(a)", 1.0, True, 1234),
    ("(5)", 1.0, False, None),
    ("(1,234", 1.0, True, None),
    ("$12", 1.0, True, None),
    ("12%", 1.0, False, None),
    ("5f", 1.0, True, None),
    ("1.005", 1000.0, True, 1004),
    ("-2.7", 1.0, True, -2),
    ("(-55)", 1.0, True, 55),
    ("  7,000  ", 1.0, True, 7000),
    ("1e3", 1.0, True, 1000),
    ("n/m", 1.0, False, None),
    ("", 1.0, False, None),
    ("99999999999999999999", 1.0, True, None),
    (".5", 10.0, True, 5),
    ("5.", 1.0, True, 5),
]


def test_cells(spark):
    df = spark.createDataFrame([(i, c, s) for i, (c, s, _, _) in enumerate(CELLS)], "i int, c string, s double")
    got = (
        df.withColumn("t", clean_cell(F.col("c")))
        .select("i", is_number_cell(F.col("t")).alias("n"), cell_amount(F.col("t"), F.col("s")).alias("a"))
        .orderBy("i")
        .collect()
    )
    for (cell, _, number, amount), row in zip(CELLS, got):
        assert row["n"] == number, cell
        if number:
            assert row["a"] == amount, cell


def test_keys_and_years(spark):
    assert values(spark, ["12", "12.0", "x", None, "", "NaN", " 7 "], coerce_key) == [12, 12, 0, 0, 0, 0, 7]
    assert values(spark, ["2014", "2014.5", "x", None], parse_year) == [2014, 0, 0, 0]


def test_whitespace_and_words(spark):
    assert values(spark, ["  a b \t\n"], strip) == ["a b"]
    assert values(spark, [" a b\n\nc ", "", " "], words) == [["a", "b", "c"], [], []]


def test_entities(spark):
    pairs = [
        ("a &amp; b", "a & b"),
        ("&nbsp;x", " x"),
        ("&amp;nbsp;", "&nbsp;"),
        ("&#151;&#x2014;&mdash;", "———"),
        ("&#146;", "’"),
        ("&#128512;", "😀"),
        ("&unknown; & x", "&unknown; & x"),
        ("&copy 2015", "© 2015"),
        ("&#0;&#xD800;&#99999999;", "���"),
        ("no entity", "no entity"),
    ]
    assert values(spark, [p[0] for p in pairs], decode_entities) == [p[1] for p in pairs]


def test_links(spark):
    assert values(spark, ["320193", "12345678901"], pad_cik) == ["0000320193", "12345678901"]
    assert values(spark, ["000320"], bare_cik) == ["320"]
    made = values(spark, ["0001-14-000002"], lambda a: archive_url(F.lit(1), a, F.lit("d.htm")))
    assert made == ["https://www.sec.gov/Archives/edgar/data/1/000114000002/d.htm"]


def test_rendering(spark):
    given = [1234000.0, 12345678.9, 0.0, -2.5, 1e15, None]
    want = ["1234000.0", "12345678.9", "0.0", "-2.5", "1000000000000000.0", None]
    assert values(spark, given, render_double, "double") == want


@pytest.mark.parametrize("n,count", [(0, 0), (1, 1), (800, 1), (801, 2), (1450, 2), (1451, 3), (2100, 3)])
def test_chunk_counts(spark, n, count):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "k int, text string")
    rows = chunks(df, "k").orderBy("chunk_idx").collect()
    assert len(rows) == count
    # Steps of 650 words rebuild the word list.
    rebuilt = []
    for r in rows:
        rebuilt[r["chunk_idx"] * 650 :] = r["text"].split(" ")
    assert rebuilt == [f"w{i}" for i in range(n)]


def test_chunk_overlap_must_be_below_size(spark):
    with pytest.raises(ValueError):
        chunks(spark.createDataFrame([(1, "a")], "k int, text string"), "k", size=5, overlap=5)


ANSWERS = [
    ('{"metric_found": true, "calculated_total_dollars": 45000000}', 45000000, None),
    ("{bad", None, "PARSE_ERROR"),
    ("", None, "PARSE_ERROR"),
    ('{"metric_found": false, "calculated_total_dollars": 1}', None, "METRIC_NOT_FOUND"),
    ('{"metric_found": true, "calculated_total_dollars": "45,000"}', None, "LLM_ERROR"),
    ('{"metric_found": "false", "calculated_total_dollars": 7}', 7, None),
    ('{"metric_found": true, "calculated_total_dollars": null}', None, "METRIC_NOT_FOUND"),
    ('{"metric_found": true, "calculated_total_dollars": 7} x', None, "PARSE_ERROR"),
    ("[7]", None, "LLM_ERROR"),
    ("7", None, "LLM_ERROR"),
    ("null", None, "LLM_ERROR"),
    ('{"metric_found": true, "calculated_total_dollars": -7.9}', -7, None),
    ('{"metric_found": 1, "calculated_total_dollars": true}', 1, None),
    ('{"metric_found": {}, "calculated_total_dollars": 1}', None, "METRIC_NOT_FOUND"),
    ('{"metric_found": [0], "calculated_total_dollars": [1]}', None, "LLM_ERROR"),
    ('{"metric_found": true, "calculated_total_dollars": 1e3}', 1000, None),
    ("{}", None, "METRIC_NOT_FOUND"),
    (None, None, "LLM_ERROR"),
]


def test_answers(spark):
    df = spark.createDataFrame([(i, a[0]) for i, a in enumerate(ANSWERS)], "i int, raw_response string")
    got = parse_answer(df).orderBy("i").collect()
    for (text, dollars, status), row in zip(ANSWERS, got):
        assert (row["answer_dollars"], row["answer_status"]) == (dollars, status), text
