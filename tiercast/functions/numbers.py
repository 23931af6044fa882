"""Keys, years, accounting-style numbers and number rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiercast import vocabulary as V
from tiercast.functions.text import strip

_FLOAT = (
    r"^[+-]?(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)"
    r"(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?$"
)
_INT = r"^[+-]?[0-9]+(?:_[0-9]+)*$"


def na_to_null(c: Column) -> Column:
    """Null out the texts that delimited files use for a missing value."""
    return F.when(~c.isin(*V.NA_TOKENS), c)


def coerce_key(c: Column) -> Column:
    """Any value to a BIGINT key; what is not a number becomes 0."""
    return F.coalesce(float_of_text(c.cast("string")).try_cast("bigint"), F.lit(0).cast("bigint"))


def fact_number(c: Column) -> Column:
    """Text of a fact to DOUBLE: the decimal grammar, and the texts of infinity and not-a-number."""
    special = strip(c).rlike(r"(?i)^[+-]?(?:inf|infinity|nan)$")
    return F.when(special, strip(c).try_cast("double")).otherwise(float_of_text(c))


def parse_year(c: Column) -> Column:
    """Whole-number text to INT; anything else becomes 0."""
    return F.coalesce(c.try_cast("int"), F.lit(0))


def float_of_text(c: Column) -> Column:
    """Text to DOUBLE under the usual decimal grammar, else null.

    The pattern is checked first because a bare cast also takes Java forms
    such as ``5f`` and ``5d``.
    """
    t = strip(c)
    return F.when(t.rlike(_FLOAT), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def int_of_text(c: Column) -> Column:
    """Text to BIGINT, else null (no decimals, no thousands commas)."""
    t = strip(c)
    return F.when(t.rlike(_INT), F.replace(t, F.lit("_"), F.lit("")).try_cast("bigint"))


def clean_cell(c: Column) -> Column:
    """Drop a trailing one-character footnote and the thousands commas."""
    no_note = F.regexp_replace(strip(c), V.FOOTNOTE_PATTERN, "")
    return strip(F.replace(no_note, F.lit(","), F.lit("")))


def is_number_cell(c: Column) -> Column:
    """True for a cleaned cell that counts as a numeric column."""
    return (c.rlike(r"(?U)\d") | c.isin(*V.DASHES)) & ~F.contains(c, F.lit("%"))


def cell_amount(c: Column, scale: Column) -> Column:
    """Cleaned cell -> scaled dollars, truncated toward zero; null if unreadable.

    Brackets round the whole text or one leading dash negate; a dash alone is
    zero.  A sign left inside survives, so ``(-5)`` gives +5.
    """
    bracketed = c.startswith("(") & c.endswith(")")
    dashed = c.startswith("-") | c.startswith("—")
    inner = (
        F.when(bracketed, F.substring(c, F.lit(2), F.length(c) - 2))
        .when(dashed, F.substring(c, F.lit(2), F.length(c)))
        .otherwise(c)
    )
    scaled = float_of_text(inner) * scale
    signed = F.when(bracketed | dashed, -scaled).otherwise(scaled)
    return F.when(dashed & ~bracketed & (inner == ""), F.lit(0).cast("bigint")).otherwise(
        signed.try_cast("bigint")
    )


def render_double(c: Column) -> Column:
    """DOUBLE to plain decimal text with at least one decimal (``1234000.0``).

    Values outside 1e-4 .. 1e16 keep Spark's exponent form.
    """
    plain = c.cast("string").try_cast("decimal(38,18)").cast("string")
    trimmed = F.regexp_replace(F.regexp_replace(plain, r"0+$", ""), r"\.$", ".0")
    ordinary = (F.abs(c) >= 1e-4) & (F.abs(c) < 1e16) | (c == 0)
    return F.when(ordinary, F.coalesce(trimmed, c.cast("string"))).otherwise(c.cast("string"))
