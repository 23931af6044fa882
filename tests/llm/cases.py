"""Small tables that the operator tests share."""

from __future__ import annotations

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names an operator might use for itself.
CLASHING = ("h", "k", "n", "t", "_row", "_id", "_t", "row", "size", "best", "sha", "kept", "keep_id", "ids", "bin", "owner", "start")


def table(spark, rows, schema=DOC_SCHEMA):
    """Rows of (doc_id, text) or (doc_id, text, lang, source)."""
    full = []
    for r in rows:
        doc_id, text = r[0], r[1]
        lang, source = (r[2], r[3]) if len(r) > 2 else ("en", "s")
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    return spark.createDataFrame(full, schema)


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def awkward(spark):
    """Nulls everywhere, empty texts, repeated rows, ties, one very long text."""
    long_text = "word another-word token=abcdefgh12 naïve 你好 " * 20_000
    return table(
        spark,
        [
            (1, "same text"),
            (1, "same text"),
            (2, "same\ttext"),
            (3, None),
            (4, ""),
            (5, " \n "),
            (None, "no id"),
            (None, "no id"),
            (6, long_text),
            (7, "same text!", None, None),
            (8, "𝒳𝒴 é é ▁ \x00 <0x0A> <|endoftext|>"),
        ],
    )
