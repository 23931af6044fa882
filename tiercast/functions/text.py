"""Whitespace, words and entity decoding for filing text."""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace, no-break space included.  Spark's plain trim() and \s
# only know ASCII, and filings pad cells with no-break spaces.
SPACE_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    """Trim any Unicode whitespace from both ends."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def collapse(c: Column) -> Column:
    """Turn every whitespace run into one space."""
    return F.regexp_replace(c, SPACE_RUN, " ")


def words(c: Column) -> Column:
    """Split on whitespace runs, no empty words."""
    return F.filter(F.split(c, SPACE_RUN), lambda w: w != "")


def contains_any(c: Column, needles) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(c, F.lit(needle))
    return found


@lru_cache(maxsize=1)
def _entity_json() -> str:
    table = {name.rstrip(";"): char for name, char in html5.items()}
    # element_at walks a map in order, so the names filings use come first.
    common = ["nbsp", "amp", "lt", "gt", "quot", "apos", "mdash", "ndash", "rsquo", "ldquo", "rdquo"]
    ordered = {name: table[name] for name in common}
    ordered.update(table)
    return json.dumps(ordered)


def _windows_1252() -> list[str]:
    return [bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in range(0x80, 0xA0)]


def _code_point(cp: Column) -> Column:
    legal = cp.between(1, 0xD7FF) | cp.between(0xE000, 0x10FFFF)
    as_char = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    low = F.get(F.array(*[F.lit(ch) for ch in _windows_1252()]), (cp - 0x80).cast("int"))
    return F.when(cp.between(0x80, 0x9F), low).when(legal, as_char).otherwise(F.lit("�"))


def _one_entity(token: Column) -> Column:
    hex_digits = F.regexp_extract(token, r"^&#[xX]0*([0-9a-fA-F]{1,8})(?![0-9a-fA-F])", 1)
    dec_digits = F.regexp_extract(token, r"^&#0*([0-9]{1,10})(?![0-9])", 1)
    name = F.regexp_extract(token, r"^&([A-Za-z][A-Za-z0-9]*)", 1)
    table = F.from_json(F.lit(_entity_json()), "map<string,string>")
    return (
        F.when(hex_digits != "", _code_point(F.conv(hex_digits, 16, 10).cast("bigint")))
        .when(dec_digits != "", _code_point(dec_digits.cast("bigint")))
        .when(token.startswith("&#"), F.lit("�"))
        .when(name != "", F.coalesce(F.try_element_at(table, name), token))
        .otherwise(token)
    )


_ENTITY_OR_TEXT = r"&(?:#[xX][0-9a-fA-F]++;?|#[0-9]++;?|[A-Za-z][A-Za-z0-9]*+;?)|[^&]++|&"


def decode_entities(c: Column) -> Column:
    """Decode named and numeric character references; unknown names stay."""
    # Filings pad cells with this one; no other reference can end in its text.
    spaced = F.replace(c, F.lit("&nbsp;"), F.lit("\u00a0"))
    decoded = F.array_join(
        F.transform(F.regexp_extract_all(spaced, F.lit(_ENTITY_OR_TEXT), F.lit(0)), _one_entity), ""
    )
    return F.when(~F.contains(c, F.lit("&")), c).when(~F.contains(spaced, F.lit("&")), spaced).otherwise(decoded)
