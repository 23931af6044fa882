"""Secret scans: find candidates in every whole text, then judge each by who else holds it.

Corpus-wide ownership frequency: the hash of every candidate value is counted over distinct
repositories and owners. A value that many owners hold is a copied example; one that stays
with few owners looks like a live credential.

Positions come from the text itself: ``split`` gives what lies between the matches and
``regexp_extract_all`` the matches, and running sums of their lengths, in a window over the
matches of one text and kind, give every span in code points. Texts without a match leave
after one test per kind. The text is scanned once; everything after works on the narrow
staged table of finds, whose row number ties spans to their row even where ids repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiercast.llm.tables import packed, text_of, unpacked
from tiercast.plans.staging import stage

REDACTED = "[REDACTED]"

# A key block: the value is all up to its END line (no other line of dashes between). Without
# one it is what goes on as header fields and base64 lines, the last of any length; a header
# that nothing of this follows, or that redaction has been over, has an empty value.
_BREAK = r"(?:\s|\\[nr])"
_END = r"-----END [A-Z ]*PRIVATE KEY-----"
_CLOSED = rf"(?!\[REDACTED\]{_END})[^-]*+(?:-{{1,4}}+[^-]++)*+(?={_END})"
_OPEN = (
    rf"(?:{_BREAK}*+[A-Za-z][A-Za-z-]*+:\x20[^\n\\-]*+(?:-{{1,4}}+[^\n\\-]++)*+)*+"
    rf"(?:{_BREAK}++[A-Za-z0-9+/]{{16,}}+={{0,2}}+)++"
    rf"(?:{_BREAK}++[A-Za-z0-9+/]{{1,15}}+={{0,2}}+(?=[\x20\t]*+(?:[\r\n\\\"']|$)))?+"
)
# Kinds in the order of the answer, pattern, the group that holds the value,
# and the least length of that value. The first three are the base kinds; the rest are the
# spans that this scan adds.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("pem", rf"-----BEGIN [A-Z ]*PRIVATE KEY-----({_CLOSED}|{_OPEN}|)(?:{_END})?", 1, 0),
)
BASE = 3

COPIED_OWNERS = 3


def _finds(kind: int) -> Column:
    """The finds of one kind in ``t``: lengths before, of the match and of its value, and the value's hash."""
    _, pattern, group, _ = KINDS[kind]
    p = F.lit(pattern)
    whole = F.regexp_extract_all("t", p, F.lit(0))
    value = F.regexp_extract_all("t", p, F.lit(group)) if group else whole
    # zip_with pads the shorter side: the last piece has no match behind it and is cut off.
    found = F.zip_with(
        F.split("t", pattern, -1),
        F.zip_with(whole, value, lambda m, v: F.struct(F.char_length(m).alias("n"), F.char_length(v).alias("v"), F.md5(v).alias("h"))),
        lambda piece, m: F.struct(F.char_length(piece).alias("gap"), m["n"].alias("n"), m["v"].alias("v"), m["h"].alias("h")),
    )
    return F.when(F.col("t").rlike(pattern), found)


def _shape(owner: str, repository: list[str]) -> tuple[Column, Column]:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repository]
    return F.coalesce(F.col(owner).cast("string"), F.lit("")), F.concat_ws("/", *parts)


def candidates(docs: DataFrame, owner: str = "source", repository: list[str] = ("source", "lang")) -> DataFrame:
    """Stage one row per document: ``row, doc_id, key, owner, repo, finds`` (``key``, of the text, and ``finds`` null where nothing was found)."""
    who, where = _shape(owner, list(repository))
    texts = docs.select("doc_id", who.alias("owner"), where.alias("repo"), text_of().alias("t"))

    def of_kind(k: int) -> Column:
        found = F.transform(_finds(k), lambda x: F.struct(F.lit(k).alias("kind"), x.alias("m")))
        return F.coalesce(found, F.array().cast("array<struct<kind:int,m:struct<gap:int,n:int,v:int,h:string>>>"))

    every = F.flatten(F.array(*[of_kind(k) for k in range(len(KINDS))]))
    marked = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "t", "owner", "repo", every.alias("finds"))
    some = F.size("finds") > 0
    return stage(marked.select("row", "doc_id", F.when(some, F.xxhash64("t")).alias("key"), "owner", "repo", F.when(some, F.col("finds")).alias("finds")), "secret-finds")


def located(found: DataFrame) -> DataFrame:
    """A row per span: ``row, doc_id, key, owner, repo, kind, start, end, h``."""
    each = found.where("finds is not null").select("row", "doc_id", "key", "owner", "repo", F.posexplode("finds").alias("i", "f"))
    flat = each.select("row", "doc_id", "key", "owner", "repo", "i", "f.kind", "f.m.*")
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.coalesce(F.col("n"), F.lit(0))).over(before)
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    return (
        flat.withColumn("end", end)
        .where("n is not null")
        .where(F.col("v") >= least)
        .select("row", "doc_id", "key", "owner", "repo", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "h")
    )


def ownership(spans: DataFrame) -> DataFrame:
    """How many owners and repositories hold each value: ``h, owners, repos``.

    Distinct (value, owner, repository) rows are made first, combined in every task, so a
    value that is everywhere reaches the exchange as a few rows.
    """
    pairs = spans.select("h", "owner", "repo").distinct()
    owners = pairs.select("h", "owner").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("owners"))
    return pairs.groupBy("h").agg(F.count(F.lit(1)).alias("repos")).join(owners, "h")


def judged(spans: DataFrame, copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """Spans with ``owners, repos, live``; a value of ``copied_owners`` or more owners is an example, as is an empty one."""
    return spans.join(ownership(spans), "h").withColumn("live", (F.col("owners") < copied_owners) & (F.col("h") != F.md5(F.lit(""))))


def _joined(items: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(items, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def report(docs: DataFrame, owner: str = "source", repository: list[str] = ("source", "lang"), copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """A row per document: ``doc_id``, base counts and digest, all spans, ``n_live``, ``n_copied``.

    A null text is empty, a null owner or repository is the empty name, repeated rows are
    answered one by one, other columns are ignored, an empty table gives an empty result.
    """
    found = candidates(docs, owner, repository)
    spans = judged(located(found), copied_owners)
    item = F.struct("start", "kind", "end")
    per_row = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(item)).alias("items"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_copied"),
    )
    items = F.coalesce("items", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    base = F.filter(items, lambda x: x["kind"] < BASE)
    count = lambda k: F.size(F.filter(items, lambda x: x["kind"] == k)).cast("long")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(items).alias("spans"),
        zero("n_live"),
        zero("n_copied"),
    )


def _blanked(text: Column, pattern: str, group: int) -> Column:
    """What lies between the matches, and the matches with their value blanked if it is live."""

    def of_match(m: Column) -> Column:
        value = F.regexp_extract(m, pattern, group) if group else m
        end = F.regexp_extract(m, _END + r"\z", 0)  # of a key block; other values end their match
        new = F.concat(F.substring(m, F.lit(1), F.char_length(m) - F.char_length(value) - F.char_length(end)), F.lit(REDACTED), end)
        return F.when(F.array_contains("_live", F.md5(value)), new).otherwise(m)

    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of_match)
    rebuilt = F.zip_with(F.split(text, pattern, -1), matches, lambda piece, m: F.concat(piece, F.coalesce(m, F.lit(""))))
    return F.array_join(rebuilt, "")


def live_values(spans: DataFrame) -> DataFrame:
    """The live values of each text, by id and text, so that rows that repeat an id (or have none) do not share a list."""
    return spans.where("live").groupBy("doc_id", "key").agg(F.collect_set("h").alias("_live")).withColumnRenamed("doc_id", "_id")


def redact(docs: DataFrame, owner: str = "source", repository: list[str] = ("source", "lang"), copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """The documents with every live-looking value replaced; copied examples and all other text stay.

    ``n_chars`` follows the text where the table has it. A text without such a value comes
    back as it was, a null text as null.
    """
    spans = judged(located(candidates(docs, owner, repository)), copied_owners)
    live = stage(live_values(spans), "live")  # its size on disk lets Spark choose whether texts must move
    text = F.col("_t")
    # Key blocks go first: what others blank inside or at the edge of one would hide it.
    for _, pattern, group, _ in sorted(KINDS, key=lambda k: k[0] != "pem"):
        text = _blanked(text, pattern, group)
    own = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_of("_t")) == F.col("key"))
    rows = packed(docs, _t=F.col("text")).join(live, own, "left")
    new = F.when(F.col("_live").isNull(), F.col("_t")).otherwise(text)
    row = F.col("_row").withField("text", new)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("_live").isNull(), F.col("_row.n_chars")).otherwise(F.char_length(new).cast(docs.schema["n_chars"].dataType)))
    return unpacked(rows.select(row.alias("_row")))
