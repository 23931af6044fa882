"""HTML documents as relations: tables, rows, cells, links and text.

How a document becomes a relation
---------------------------------
1. Next to the scan, a document's markup is replaced by single marks, a few passes
   over the whole text.  One plain split then cuts it into tokens: *parts* start at its
   ``table`` and ``tr`` tags, cells at its ``td`` and ``th`` tags, and text goes on after
   any other.  The text of a token is a trimmed, entity-decoded piece.
2. The document's *shape* is one short string, a letter per part, cell and piece.
   It is split into *events*, the letters of one part, and these are unfolded into
   rows next to the scan; one exchange by document at most.  Counts are read off the letters.
   The pieces stay in the document's first event - beside them, every
   event row would be made with a copy of them - and the markup stays behind.
3. Running sums give each event its table depth.  Inside one depth level a
   table, row or open cell ends at the next event of its kind or above, which
   one backward running window finds.  Nesting may be of any depth.
4. Because an element covers a contiguous stretch of the document, its rows,
   cells and text pieces are plain ranges ``[lo, hi)`` of the document's ordered
   lists.  Nested rows and cells fall inside the outer ranges by themselves,
   so containment needs neither a join nor a copy of the text.

A window partition is one document, which is one string value to begin with,
so no partition can outgrow a single input row.  Keys must be unique per
document; ``sources.documents.one_per_url`` makes them so.

An unclosed cell or row ends at the next one of the same table depth, and an
unclosed table at the end of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiercast.functions.text import SPACE_CHARS, decode_entities, strip

# Rest of a tag up to its end.  Quotes count only right after an equals sign, and
# one that never closes does not swallow what follows.
_ATTRS = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|["'])*+>"""
# Every alternative below starts with the same character, kept in front so that
# matching fails at once on any other.
_MARKUP = (
    r"<(?:!--.*?-->"
    r"|(?i:script)(?=[\s/>]).*?(?:</(?i:script)\s*+>|\z)"
    r"|(?i:style)(?=[\s/>]).*?(?:</(?i:style)\s*+>|\z)"
    rf"|[a-zA-Z/!?]{_ATTRS})"
)
TOKEN_PATTERN = rf"(?s){_MARKUP}|[^<]++|<"

_TABLE_OR_ROW = r"</?(?i:table|tr)(?=[\s/>])"
_INSIDE = rf"(?:[^<]++|{_MARKUP}|<)"
# A part is a table or row tag and all that follows it up to the next.
PART_PATTERN = rf"(?s)(?:{_TABLE_OR_ROW}{_ATTRS})?+(?:(?!{_TABLE_OR_ROW}){_INSIDE})*+"

# Marks put in place of markup, which is then cut with plain splits.  A tag's name stands
# between the mark of a part or cell and the end of its name.
_CELL_MARK, _NAME_END, _PART_MARK, _BREAK, _CLOSED, _ESCAPE = (chr(i) for i in range(1, 7))
_SHAPING = r"/?(?i:table|tr|td|th)"
# Group 1 is a plain closing tag of a cell, 2 another shaping tag, 3 the bracket of one that never ends.
# All start with one bracket; 3 is taken last, as a group that was set is not unset.
MARK_PATTERN = (
    rf"(?s)<(?:(/(?i:td|th)\s*+>)|({_SHAPING})(?=[\s/>]){_ATTRS}|{_MARKUP.removeprefix('<').removeprefix('(?:').removesuffix(')')}"
    rf"|(?={_SHAPING}[\s/>])(?<=(<)))"
)
_PART_START = rf"{_CELL_MARK}(?=/?(?i:table|tr){_NAME_END}|<{_NAME_END}/?(?i:table|tr)[\s/>])"
# A cell takes its own closing tag along when nothing follows that it would bound.
_OWN_END = (
    rf"({_CELL_MARK}(?i:td|th){_NAME_END}[^{_CELL_MARK}{_PART_MARK}]*+){_CELL_MARK}/(?i:td|th)%s>{_NAME_END}"
    rf"(?=\s*+(?:{_CELL_MARK}(?i:td|th){_NAME_END}|{_CELL_MARK}<{_NAME_END}(?i:td|th)[\s/>]|{_PART_MARK}|\z))"
)
_SPACED_END = rf"{_CELL_MARK}/(?i:td|th)\s"
_EMPTY_ELEMENT = r"(?i)<(table|tr|td|th)((?:\s[^<>\"']*(?:\"[^\"<>]*\"|'[^'<>]*')?)*)\s*/>"
_ANCHOR_PATTERN = r"""(?is)<a(?=[\s>])(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|["'])*+>"""
_HREF = r"""(?is)\shref\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']*+))"""

# Part codes; REST is the text at the start and after a closed table.
REST, TABLE, TABLE_END, ROW, ROW_END = 0, 1, 2, 3, 4
# A document's shape is a string: a letter per part, cell and end of a cell (below), ``p`` per
# text piece, ``a`` per link of a part, ``z`` where a cell brings its closing tag along.
_LETTERS = {
    "td": "d",
    f"{_PART_MARK}tr": "R",
    f"{_PART_MARK}/tr": "S",
    _BREAK: "",
    "th": "h",
    f"{_PART_MARK}table": "T",
    f"{_PART_MARK}/table": "E",
    f"{_PART_MARK}<": "x",
    "": "x",
    "<": "o",
}
_EVENT_START = "(?=[TERSx])"
_CELL_START = "(?=[dheo])"


def settle_comments(c: Column) -> Column:
    """Respell comment openers that no ``-->`` follows, so that no pattern looks for one from each.

    Such an opener is a plain declaration up to the next bracket, and text where none follows.
    """
    tail = F.substring_index(c, "-->", -1)
    last = F.substring_index(tail, ">", -1)
    head = F.substring(c, F.lit(1), F.length(c) - F.length(tail))
    middle = F.substring(tail, F.lit(1), F.length(tail) - F.length(last))
    opener = F.lit("<!--")
    settled = F.concat(head, F.replace(middle, opener, F.lit("<!-")), F.replace(last, opener, F.lit("&lt;!--")))
    return F.when(F.contains(tail, opener), settled).otherwise(c)


def tokens(c: Column) -> Column:
    """Markup tags and text runs of a document, in order, nothing lost (unclosed comments respelled)."""
    return F.regexp_extract_all(settle_comments(c), F.lit(TOKEN_PATTERN), F.lit(0))


def token_tag(token: Column) -> Column:
    """Lower-case tag name of a token (``/li`` for a close), '' for text."""
    return F.lower(F.regexp_extract(token, r"^<(/?[a-zA-Z][^\s/>]*)", 1))


def _escaped(c: Column) -> Column:
    """The text without any character that serves as a mark."""
    marks = (_ESCAPE, _CELL_MARK, _NAME_END, _PART_MARK, _BREAK, _CLOSED)
    spelled = c
    for letter, mark in zip("abcdef", marks):
        spelled = F.replace(spelled, F.lit(mark), F.lit(_ESCAPE + letter))
    return F.when(c.rlike(f"[{_CELL_MARK}-{_ESCAPE}]"), spelled).otherwise(c)


def _unescaped(c: Column) -> Column:
    spelled = c
    for letter, mark in zip("bcdefa", (_CELL_MARK, _NAME_END, _PART_MARK, _BREAK, _CLOSED, _ESCAPE)):
        spelled = F.replace(spelled, F.lit(_ESCAPE + letter), F.lit(mark))
    return F.when(F.contains(c, F.lit(_ESCAPE)), spelled).otherwise(c)


def _marked(c: Column) -> Column:
    """A document with its markup replaced by marks; of shaping tags the names stay."""
    named = F.regexp_replace(_escaped(c), MARK_PATTERN, f"{_CELL_MARK}$1$2$3{_NAME_END}")
    broken = F.replace(named, F.lit(_CELL_MARK + _NAME_END), F.lit(_BREAK))
    parted = F.regexp_replace(broken, _PART_START, _PART_MARK)
    ended = F.regexp_replace(parted, _OWN_END % "", f"$1{_CLOSED}")
    # One with a space in it is taken along too, but closes nothing.
    spaced = F.when(ended.rlike(_SPACED_END), F.regexp_replace(ended, _OWN_END % r"\s++", "$1")).otherwise(ended)
    # Filings pad cells with this one; other references are decoded piece by piece.
    return F.replace(spaced, F.lit("&nbsp;"), F.lit("\u00a0"))


def _text(token: Column) -> Column:
    """Trimmed, decoded text of a token."""
    text = F.substring_index(token, _NAME_END, -1)
    odd = strip(decode_entities(_unescaped(F.replace(text, F.lit(_CLOSED), F.lit("")))))
    is_odd = F.contains(text, F.lit("&")) | F.contains(text, F.lit(_ESCAPE))
    return F.when(is_odd, odd).otherwise(F.btrim(text, F.lit(SPACE_CHARS + _CLOSED)))


def href(anchor: Column) -> Column:
    """Address of an ``<a>`` tag, null when it has none."""
    value = F.concat(*[F.regexp_extract(anchor, _HREF, g) for g in (1, 2, 3)])
    return F.when(anchor.rlike(_HREF), decode_entities(value))


def anchors(c: Column) -> Column:
    """``href`` of each ``<a>`` in order; null where the tag has no address."""
    found = F.regexp_extract_all(c, F.lit(_ANCHOR_PATTERN), F.lit(0))
    return F.transform(found, lambda a: F.struct(href(a).alias("href")))


def _letter(token: Column) -> Column:
    """What a token starts: a letter, none for text that goes on after other markup."""
    name = F.lower(F.substring_index(token, _NAME_END, 1))
    other = F.try_element_at(F.create_map(*[F.lit(x) for pair in _LETTERS.items() for x in pair]), name)
    # The usual spellings first, then any other.
    letter = F
    for spelled, code in _LETTERS.items():
        letter = letter.when(F.startswith(token, F.lit(spelled + _NAME_END)), code)
    return letter.otherwise(F.coalesce(other, F.lit("e")))


def _spelled(token: Column, text: Column) -> Column:
    """Letters of one token: what it starts, ``p`` for its text and ``z`` for its own closing tag."""
    closed = F.endswith(token, F.lit(_CLOSED)) | (
        F.endswith(token, F.lit(" ")) & F.endswith(F.rtrim(token), F.lit(_CLOSED))
    )
    return F.concat(_letter(token), F.when(text != "", "p").otherwise(""), F.when(closed, "z").otherwise(""))


def _linked(shape: Column, counts: Column) -> Column:
    """``shape`` with one ``a`` per link behind the letter of each part."""
    parts = F.transform(
        F.split(shape, _EVENT_START),
        lambda s, i: F.concat(
            F.left(s, F.lit(1)), F.repeat(F.lit("a"), F.coalesce(F.get(counts, i), F.lit(0))), F.substring(s, 2, 1 << 30)
        ),
    )
    return F.array_join(parts, "")


def _events_of(shape: Column) -> Column:
    """Letters of each event; what follows a closed table becomes its own event.

    A row end, and text after a table, say nothing when nothing is in them - but a
    row end stays where a table follows outside any row.  The first event always stays.
    """
    said = F.regexp_replace(shape, "o(?!p)", "")
    apart = F.regexp_replace(said, "E(?=[^TERSx])", "Ex")
    return F.split(F.regexp_replace(apart, "(?<=.)(?:x(?=[TERSx]|$)|S(?=[ERSx]|$))", ""), _EVENT_START)


def _count(letters: Column, wanted: str) -> Column:
    rest = F.replace(letters, F.lit(wanted), F.lit("")) if len(wanted) == 1 else F.translate(letters, wanted, "")
    return F.length(letters) - F.length(rest)


def parse(docs: DataFrame, key: str, html: str = "html", links: bool = False) -> DataFrame:
    """One row per document: ``key, pieces, links, tables, rows, cells``.

    ``tables`` holds structs ``(pos, depth, row_lo, row_hi, piece_lo, piece_hi)``
    in document order, ``rows`` ``(pos, cell_lo, cell_hi, piece_lo, piece_hi,
    link_lo, link_hi)`` and ``cells`` ``(is_data, piece_lo, piece_hi)``.
    Rows outside any table are listed too; no table range covers them.
    Documents with null HTML are left out; empty ones give empty lists.
    """
    spelled = F.when(
        F.contains("_h", F.lit("/>")), F.regexp_replace("_h", _EMPTY_ELEMENT, "<$1$2></$1>")
    ).otherwise(F.col("_h"))
    settled = docs.filter(F.col(html).isNotNull()).select(key, settle_comments(F.col(html)).alias("_h"))
    # Links are read off the markup of the same parts.
    markup = F.filter(F.regexp_extract_all(spelled, F.lit(PART_PATTERN), F.lit(0)), lambda s: s != "")
    whole = F.concat(F.lit(_NAME_END), _marked(spelled))
    for mark, after in ((_PART_MARK, _CELL_MARK + _PART_MARK), (_BREAK, _CELL_MARK + _BREAK + _NAME_END)):
        whole = F.replace(whole, F.lit(mark), F.lit(after))
    found = [F.transform(markup, anchors).alias("_a")] if links else []
    cut_up = settled.select(key, F.split(whole, _CELL_MARK).alias("_s"), *found)
    # Columns of their own here and below, as they are looked at from more than one place.
    read = cut_up.select("*", F.transform("_s", _text).alias("_x"))
    shape = F.array_join(F.zip_with("_s", "_x", _spelled), "")
    # Nothing at all before the first part is no part.
    none = (F.get("_s", F.lit(0)) == _NAME_END) & F.startswith(F.get("_s", F.lit(1)), F.lit(_PART_MARK))
    hrefs = F.flatten("_a")["href"] if links else F.array().cast("array<string>")
    shaped = read.select(
        key,
        F.struct(F.filter("_x", lambda t: t != "").alias("p"), hrefs.alias("l")).alias("_t"),
        shape.alias("_s"),
        F.coalesce(none, F.lit(False)).alias("_none"),
        *(["_a"] if links else []),
    )
    parts = F.when(F.col("_none"), F.substring("_s", 2, 1 << 30)).otherwise(F.col("_s"))
    if links:
        parts = _linked(parts, F.transform("_a", F.size))
    held = shaped.select(key, "_t", parts.alias("_s")).select(key, "_t", "_s", _events_of(F.col("_s")).alias("_e"))
    # The text stays in the document's first event, out of the windows' way.
    spread = held.select(
        key,
        F.struct(_count(F.col("_s"), "p").alias("p"), _count(F.col("_s"), "a").alias("a"), _count(F.col("_s"), "dh").alias("c"), _count(F.col("_s"), "R").alias("r")).alias("_all"),
        F.transform("_e", lambda e, i: F.struct(e.alias("shape"), F.when(i == 0, F.col("_t")).alias("text"))).alias("_e"),
    )
    # The outer form on purpose: for the inner one Spark infers a filter on the
    # array and computes it again, regular expressions and all, for that filter.
    unfolded = spread.select(key, "_all", F.posexplode_outer("_e").alias("pos", "_e")).select(
        key, "_all", "pos", "_e.shape", "_e.text"
    )
    letters = F.col("shape")
    tag = F.lit(REST)
    for letter, code in (("S", ROW_END), ("E", TABLE_END), ("T", TABLE), ("R", ROW)):
        tag = F.when(F.startswith(letters, F.lit(letter)), code).otherwise(tag)
    first = F.substring_index(F.translate(letters, "he", "dd"), "d", 1)
    events = unfolded.select(
        "*",
        tag.alias("tag"),
        _count(letters, "a").alias("a"),
        _count(letters, "p").alias("n"),
        _count(letters, "dh").alias("c"),
        F.when(F.length(first) < F.length(letters), _count(first, "p")).alias("until_tag"),
    )

    forward = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    tag = F.col("tag")
    is_row = (tag == ROW).cast("int")
    before = lambda c: (F.sum(c).over(forward) - c).cast("int")
    counted = events.select(
        "*",
        F.sum(F.when(tag == TABLE, 1).when(tag == TABLE_END, -1).otherwise(0)).over(forward).alias("raw"),
        before(F.col("n")).alias("p0"),
        before(F.col("a")).alias("a0"),
        before(F.col("c")).alias("c0"),
        before(is_row).alias("r0"),
    )
    # A close without an open must not push the depth below zero for good.
    depth = F.col("raw") - F.least(F.lit(0), F.min("raw").over(forward))
    levelled = counted.withColumn("depth", depth.cast("int")).withColumn(
        "level", F.col("depth") + (tag == TABLE_END).cast("int")
    )

    backward = (
        Window.partitionBy(key, "level").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    upcoming = lambda when, what: F.last(F.when(when, what), ignorenulls=True).over(backward)
    # Where an event ends a cell left open before it: at its start, or at the
    # first cell tag of text that merely goes on after a nested table.
    cell_stop = F.when(tag != REST, F.col("p0")).otherwise(F.col("p0") + F.col("until_tag"))
    is_edge = tag.isin(TABLE, TABLE_END)
    ended = levelled.withColumn("_stop", cell_stop).select(
        *levelled.columns,
        upcoming(F.col("_stop").isNotNull(), F.col("_stop")).alias("cell_end"),
        upcoming(is_edge | tag.isin(ROW, ROW_END), F.struct("p0", "a0", "c0")).alias("row_end"),
        upcoming(is_edge, F.struct("p0", "r0")).alias("table_end"),
    )
    # An element with no end event runs to the end of the document.
    upto = lambda found, total: F.coalesce(F.col(found), F.col(f"_all.{total}"))
    table = F.struct(
        F.col("pos"),
        F.col("depth"),
        F.col("r0").alias("row_lo"),
        upto("table_end.r0", "r").alias("row_hi"),
        F.col("p0").alias("piece_lo"),
        upto("table_end.p0", "p").alias("piece_hi"),
    )
    row = F.struct(
        F.col("pos"),
        F.col("c0").alias("cell_lo"),
        upto("row_end.c0", "c").alias("cell_hi"),
        F.col("p0").alias("piece_lo"),
        upto("row_end.p0", "p").alias("piece_hi"),
        F.col("a0").alias("link_lo"),
        upto("row_end.a0", "a").alias("link_hi"),
    )
    # Cells of an event and the pieces before each, added up once, not once more for every cell.
    each = F.when(F.col("c") > 0, F.split(letters, _CELL_START))
    sums = F.aggregate(
        F.col("_each"),
        F.array(F.col("p0")),
        lambda s, c: F.concat(s, F.array((F.element_at(s, -1) + _count(c, "p")).cast("int"))),
    )
    split_up = ended.select(
        key, "text", "tag", "pos", upto("cell_end", "p").cast("int").alias("_end"), table.alias("_table"), row.alias("_row"), "p0", each.alias("_each")
    ).select("*", sums.alias("_sums"))
    last = F.size("_each") - 1
    ranges = F.transform(
        "_each",
        lambda c, i: F.when(
            F.startswith(c, F.lit("d")) | F.startswith(c, F.lit("h")),
            F.struct(
                F.startswith(c, F.lit("d")).alias("is_data"),
                F.get("_sums", i).alias("piece_lo"),
                F.when((i == last) & ~F.endswith(c, F.lit("z")), F.col("_end")).otherwise(F.get("_sums", i + 1)).alias("piece_hi"),
            ),
        ),
    )
    inside = F.when(F.col("_each").isNotNull(), F.struct("pos", F.filter(ranges, lambda c: c.isNotNull()).alias("cells")))
    gathered = split_up.groupBy(key).agg(
        # Not first(): its buffer would copy the whole text again for every event.
        F.get(F.collect_list("text"), F.lit(0)).alias("text"),
        F.sort_array(F.collect_list(F.when(F.col("tag") == TABLE, F.col("_table")))).alias("tables"),
        F.sort_array(F.collect_list(F.when(F.col("tag") == ROW, F.col("_row")))).alias("rows"),
        F.sort_array(F.collect_list(inside)).alias("inside"),
    )
    return gathered.select(
        key, F.col("text.p").alias("pieces"), F.col("text.l").alias("links"), "tables", "rows", F.flatten("inside.cells").alias("cells")
    )


# --- ranges of a parsed document, as expressions --------------------------------


def cut(items: Column, lo: Column, hi: Column) -> Column:
    """Elements ``lo`` (counted from 0) up to, not including, ``hi``.

    Elements are taken one by one, which costs what is taken; ``slice`` would walk
    the whole document's list each time.
    """
    taken = F.transform(F.sequence(lo, hi - 1), lambda i: F.get(items, i))
    return F.when(hi > lo, taken).otherwise(F.slice(items, 1, 0))


def text_of(element: Column, separator: str, parts: Column | None = None) -> Column:
    """Text of a table, row or cell: its pieces joined by ``separator``."""
    parts = F.col("pieces") if parts is None else parts
    lo, hi = element["piece_lo"], element["piece_hi"]
    # Most cells hold one piece or none.
    return F.when(hi - lo == 1, F.get(parts, lo)).when(hi <= lo, "").otherwise(F.array_join(cut(parts, lo, hi), separator))


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rows_of(table: Column) -> Column:
    return cut(F.col("rows"), table["row_lo"], table["row_hi"])


def cells_of(row: Column) -> Column:
    return cut(F.col("cells"), row["cell_lo"], row["cell_hi"])


# --- relations --------------------------------------------------------------------
# Each relation is shaped inside the document's row and only then unfolded, so no
# document list is copied per table or per row.


def tables(parsed: DataFrame, key: str) -> DataFrame:
    """``key, table_idx, depth, n_rows, text``: every table, nested ones too."""
    shaped = F.transform(
        "tables",
        lambda t: F.struct(
            t["depth"].alias("depth"), (t["row_hi"] - t["row_lo"]).alias("n_rows"), text_of(t, " ").alias("text")
        ),
    )
    return parsed.select(key, F.posexplode_outer(shaped).alias("table_idx", "t")).filter(F.col("t").isNotNull()).select(
        key, "table_idx", "t.*"
    )


def rows(parsed: DataFrame, key: str) -> DataFrame:
    """``key, table_idx, row_idx, n_cells, text``; outer tables list nested rows."""
    shaped = F.flatten(
        F.transform(
            "tables",
            lambda t, i: F.transform(
                rows_of(t),
                lambda r, j: F.struct(
                    i.alias("table_idx"),
                    j.alias("row_idx"),
                    (r["cell_hi"] - r["cell_lo"]).alias("n_cells"),
                    text_of(r, " ").alias("text"),
                ),
            ),
        )
    )
    return parsed.select(key, F.explode_outer(shaped).alias("r")).filter(F.col("r").isNotNull()).select(key, "r.*")


def cells(parsed: DataFrame, key: str) -> DataFrame:
    """``key, table_idx, row_idx, cell_idx, is_data, text, joined``.

    ``text`` puts a space between pieces, ``joined`` nothing.
    """
    shaped = F.flatten(
        F.transform(
            "tables",
            lambda t, i: F.flatten(
                F.transform(
                    rows_of(t),
                    lambda r, j: F.transform(
                        cells_of(r),
                        lambda c, k: F.struct(
                            i.alias("table_idx"),
                            j.alias("row_idx"),
                            k.alias("cell_idx"),
                            c["is_data"].alias("is_data"),
                            text_of(c, " ").alias("text"),
                            text_of(c, "").alias("joined"),
                        ),
                    ),
                )
            ),
        )
    )
    return parsed.select(key, F.explode_outer(shaped).alias("c")).filter(F.col("c").isNotNull()).select(key, "c.*")


# --- Markdown and plain text ---------------------------------------------------------


def _table_markdown(table: Column) -> Column:
    """Markdown grid of one table; '' when it has no rows or no cells."""

    def line(row, width):
        texts = F.transform(cells_of(row), lambda c: F.replace(text_of(c, " "), F.lit("\n"), F.lit(" ")))
        missing = F.greatest(width - (row["cell_hi"] - row["cell_lo"]), F.lit(0))
        return F.concat(
            F.lit("| "), F.array_join(F.concat(texts, F.array_repeat(F.lit(""), missing)), " | "), F.lit(" |")
        )

    def grid(width):
        ruled = F.transform(
            rows_of(table),
            lambda r, i: F.concat(
                line(r, width),
                F.when(i == 0, F.concat(F.lit("\n|"), F.repeat(F.lit("---|"), width))).otherwise(""),
            ),
        )
        return F.when(width > 0, F.array_join(ruled, "\n")).otherwise("")

    return bind(_width(table), grid)


def _width(table: Column) -> Column:
    """Cells in a table's widest row, 0 without rows."""
    return F.coalesce(F.array_max(F.transform(rows_of(table), lambda r: r["cell_hi"] - r["cell_lo"])), F.lit(0))


def markdown(parsed: DataFrame, key: str) -> DataFrame:
    """``key, table_idx, width, markdown`` for every table."""
    shaped = F.transform(
        "tables",
        lambda t: F.struct(
            _width(t).alias("width"),
            _table_markdown(t).alias("markdown"),
        ),
    )
    return parsed.select(key, F.posexplode_outer(shaped).alias("table_idx", "t")).filter(F.col("t").isNotNull()).select(
        key, "table_idx", "t.*"
    )


def plain_text(parsed: DataFrame, key: str, out: str = "text") -> DataFrame:
    """``key, text``: outermost tables as Markdown in place, all else as text."""
    outer = F.filter("tables", lambda t: t["depth"] == 1)
    with_outer = parsed.select(key, "pieces", "rows", "cells", outer.alias("_o"))
    bounds = F.transform(
        "_o",
        lambda t, i: F.struct(
            # Text between the end of the previous outermost table and this one.
            F.coalesce(F.get(F.col("_o"), i - 1)["piece_hi"], F.lit(0)).alias("lo"),
            t["piece_lo"].alias("hi"),
            F.array(_table_markdown(t)).alias("md"),
        ),
    )
    tail_lo = F.coalesce(F.get(F.col("_o"), F.size("_o") - 1)["piece_hi"], F.lit(0))
    laid = F.concat(
        F.flatten(F.transform(bounds, lambda b: F.concat(cut(F.col("pieces"), b["lo"], b["hi"]), b["md"]))),
        cut(F.col("pieces"), tail_lo, F.size("pieces")),
    )
    joined = F.array_join(F.filter(laid, lambda p: p != ""), " ")
    spaced = F.regexp_replace(joined, r"[ \t]+", " ")
    return with_outer.select(key, F.regexp_replace(spaced, r"(?U)\n[\s\x1c-\x1f]*\n", "\n\n").alias(out))
