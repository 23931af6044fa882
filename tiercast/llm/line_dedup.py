"""Line dedup: drop boilerplate, i.e. lines that are spread over many distinct sites.

A HyperLogLog sketch of the sites is built per line hash in every task and merged by the
aggregation, so a line that is everywhere reaches the exchange as one small sketch per task.
Lines whose estimate lies within ``band`` of the threshold are counted exactly, over distinct
(line, site) rows; the sketch alone decides those that are clearly under or over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercast.llm.tables import packed, text_of, unpacked, wide_hash
from tiercast.plans.staging import stage

SITES = 5
# Half the threshold to either side: with 2 ** 10 registers (standard error 3 %) over fifteen deviations.
BAND = 0.5
LG_K = 10


def _key(line: Column) -> Column:
    """What makes lines equal: their text without white space at the ends, by 128 bits; null for a blank line."""
    core = F.btrim(line, F.lit(" \t\r"))
    return F.when(core != "", wide_hash(core))


def _every_key(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), _key)


def _keys(text: Column) -> Column:
    return F.filter(_every_key(text), lambda k: k.isNotNull())


def _without(text: Column, gone: Column) -> Column:
    """The lines of a text but for those at the positions ``gone``, in time linear in them."""

    def of_lines(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.transform(stay, lambda i: lines[i])

    return F.transform(F.array(F.split(text, "\n", -1)), of_lines)[0]  # bound once, not split again for each line


def boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES, band: float = BAND) -> DataFrame:
    """Keys ``k`` of the lines found on at least ``sites`` distinct sites (a null site is one site, the empty name)."""
    where = F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site")
    lines = docs.select(where, F.explode(_keys(text_of())).alias("k"))
    sketches = lines.groupBy("k").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    about = stage(
        sketches.select("k", F.hll_sketch_estimate("sketch").alias("about")).where(F.col("about") >= sites * (1 - band)), "line-spread"
    )
    over = about.where(F.col("about") > sites * (1 + band)).select("k")
    near = about.where(F.col("about") <= sites * (1 + band)).select("k")
    exact = lines.join(near, "k", "left_semi").distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return stage(over.unionByName(exact.where(F.col("n") >= sites).select("k")), "boilerplate")


def clean(docs: DataFrame, site: str = "source", sites: int = SITES, band: float = BAND) -> DataFrame:
    """The documents as a struct ``_row`` without their boilerplate lines, beside ``n_lines`` and ``n_removed`` in a struct ``_lines``.

    All columns of the input stay in ``_row`` (``n_chars`` follows the text where the table has it). Every copy of a boilerplate line goes; blank
    lines stay. A null text stays null and has no lines, an empty one has one blank line.
    Rows that repeat an id are cleaned alike; an empty table gives an empty result.
    """
    marked = boilerplate(docs, site, sites, band)
    held = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(text_of()).alias("_of"), F.posexplode(_every_key(text_of())).alias("at", "k"))
    bad = held.where("k is not null").join(marked, "k", "left_semi").groupBy("_id", "_of").agg(F.collect_set("at").alias("_gone"))
    own = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_of("_t")) == F.col("_of"))
    rows = packed(docs, _t=F.col("text")).join(bad, own, "left")
    lines = F.split("_t", "\n", -1)
    kept = F.when(F.col("_gone").isNull(), lines).otherwise(_without(F.col("_t"), F.col("_gone")))
    made = rows.select("_row", lines.alias("_all"), kept.alias("_kept"))
    text = F.array_join("_kept", "\n")
    row = F.col("_row").withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType))
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    n_lines = F.when(F.col("_all").isNull(), F.lit(0).cast("long")).otherwise(count(F.col("_all")))
    n_kept = F.when(F.col("_all").isNull(), F.lit(0).cast("long")).otherwise(count(F.col("_kept")))
    return made.select(row.alias("_row"), F.struct(n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_removed")).alias("_lines"))


def cleaned(docs: DataFrame, **how) -> DataFrame:
    """Only the documents, in their own columns."""
    return unpacked(clean(docs, **how).select("_row"))
