"""Exact dedup: group by 128-bit content hash, compare bytes inside groups, keep one row.

Texts are equal when identical after deleting every character of ``[\\x20\\x09-\\x0D]``.

Plan: texts are grouped by their hash *and* their normalised bytes, so equal hashes with
unequal bytes fall apart. The grouping combines before its exchange: of thousands of copies
in one task a single text travels, whatever share of the rows they hold. Each class is then
named by hash and SHA-256, and a second, narrow scan (id, hash, SHA-256) is joined with the
classes of two or more rows; that join has nothing above it, so Spark may split a hot class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercast.llm.tables import packed, text_of, unpacked
from tiercast.plans.staging import stage

# The white space that does not count.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE_SPACE, "")


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text; tests replace it to force collisions."""
    return F.unhex(F.md5(text))


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def groups(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """A row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the one with the most code points stays, then the smallest id.
    Null text is empty; empty texts equal each other. Null ids come last and are kept as
    null. Rows that repeat an id and a text are counted singly and marked alike. Other
    columns are ignored, an empty table gives an empty result.
    """
    texts = docs.select("doc_id", text_of().alias("t")).select("doc_id", F.char_length("t").alias("points"), normalised(F.col("t")).alias("n"))
    # "Most code points, then smallest id, null last" is the least of these structs.
    order = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"))
    classes = (
        texts.withColumn("h", hash_of(F.col("n")))
        .groupBy("h", "n")
        .agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("best"))
        .where("size > 1")
        .select("h", _sha(F.col("n")).alias("sha"), "size", F.col("best.id").alias("best_id"))
    )
    rows = texts.select("doc_id", hash_of(F.col("n")).alias("h"), _sha(F.col("n")).alias("sha"))
    keep_id = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("best_id"))
    return rows.join(classes, ["h", "sha"], "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; rows that repeat id and text stay together."""
    # Beside the id the hash only tells apart rows that share one.
    dropped = groups(docs).where("not kept").select(F.col("doc_id").alias("_id"), F.xxhash64("text_sha256").alias("_key"))
    gone = stage(dropped.distinct(), "gone")  # its size on disk lets Spark choose whether texts must move
    rows = packed(docs, _mine=F.xxhash64(F.sha2(normalised(text_of()), 256)))
    return unpacked(rows.join(gone, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_mine") == F.col("_key")), "left_anti"))
