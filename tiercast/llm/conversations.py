"""Repair of conversation structure: the cheapest edits that give ``(s?(ua)+)?``.

Rows lie in one global order (conversation, turn), sorted by range, and are cut into segments of at
most ``SEGMENT`` rows; one conversation may span any number of segments and tasks. A segment is a
short text, one sign a row (what its role is and what is wrong with it), so equal segments are
solved once.

The solution of a segment is a shortest path in a DAG whose nodes are (row, state of the pattern)
and whose weights are plain integers: high digits carry cost, low digits the letters of the edits,
first letter highest and zeros at the end. The least integer is thus the cheapest path and, among
those, the one whose letters come first in ASCII; no other rule decides anything. A segment of a longer
conversation is solved from every state to every state, and the solutions are joined from the last
to the first. (That is exact: edits of one segment that cost the same are never the beginning of one
another, as what one has more could only be inserts, which cost.)

The digest of a repaired conversation is one running hash, so its lines pass one task in order, a
batch at a time; nothing else of a conversation is ever together but the letters of its audit.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercast.llm.tables import ship
from tiercast.plans.staging import stage

SEGMENT_BITS = 12  # rows of a segment: 2 ** 12 at most
WHITE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# Digits of the letters, in ASCII order.
LETTERS = "DIKR"
DIGIT = {letter: n + 1 for n, letter in enumerate(LETTERS)}
DIGIT_BITS = 3

# States of the pattern: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
# Inserted rows that lead from one state to another; more of them would only cost.
INSERTS = [
    [(START, 0), (USER, 1), (ASSISTANT, 2)],
    [(SYSTEM, 0), (USER, 1), (ASSISTANT, 2)],
    [(USER, 0), (ASSISTANT, 1)],
    [(ASSISTANT, 0), (USER, 1)],
]
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # inserts that end the pattern
# A sign is 4 * fault + role.
ROLES = "sua"
SOUND, CUT, BLANK, REPEAT = range(4)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def edits(sign: str) -> list[tuple[str, int, str | None]]:
    """What may be done to a row: letter, cost and the role it then has."""
    fault, role = divmod(int(sign, 16), 4)
    out: list[tuple[str, int, str | None]] = [("D", DELETE, None)]
    if fault in (SOUND, CUT):
        extra = TRUNCATED if fault == CUT else 0
        if role < 3:
            out.append(("K", extra, ROLES[role]))
        out += [("R", REROLE + extra, "u"), ("R", REROLE + extra, "a")]
    return out


def width(rows: int) -> int:
    """Bits of the letters of so many rows: at most two inserts before each, and two at the end."""
    return DIGIT_BITS * (3 * rows + 2)


def moves(sign: str) -> list[list[tuple[int, int, str]]]:
    """For each state before a row: state after it, cost and letters of all that can happen there."""
    out = []
    for state in range(4):
        mine = []
        for middle, inserted in INSERTS[state]:
            for letter, cost, role in edits(sign):
                after = middle if role is None else STEPS[middle].get(role)
                if after is not None:
                    mine.append((after, INSERT * inserted + cost, "I" * inserted + letter))
        out.append(mine)
    return out


_MOVES = {sign: moves(sign) for sign in "0123456789abcdef"}


def number(cost: int, letters: str, bits: int) -> int:
    """Cost and letters as one integer with ``bits`` low bits."""
    digits = 0
    for letter in letters:
        digits = digits << DIGIT_BITS | DIGIT[letter]
    return cost << bits | digits << (bits - DIGIT_BITS * len(letters))


def letters_of(weight: int, bits: int) -> tuple[int, str]:
    """Cost and letters of an integer."""
    cost, digits = weight >> bits, weight & ((1 << bits) - 1)
    if not digits:
        return cost, ""
    used = -(-(bits - ((digits & -digits).bit_length() - 1)) // DIGIT_BITS)
    octal = f"{digits >> (bits - DIGIT_BITS * used):o}".zfill(used)
    return cost, "".join(LETTERS[int(d) - 1] for d in octal)


def after(weight: int, head_cost: int, head: str, bits: int) -> int:
    """An integer with more letters put before its own."""
    cost, digits = weight >> bits, weight & ((1 << bits) - 1)
    return number(head_cost + cost, head, bits) | digits >> (DIGIT_BITS * len(head))


def paths(signs: str, ends: list[int | None], bits: int) -> list[int | None]:
    """Least integer from each state before the rows, given the integers after them."""
    best = ends
    mask = (1 << bits) - 1
    for sign in reversed(signs):
        new: list[int | None] = []
        for choices in _MOVES[sign]:
            least = None
            for state, cost, letters in choices:
                rest = best[state]
                if rest is not None:
                    here = ((cost + (rest >> bits)) << bits) + _head(letters, bits) + ((rest & mask) >> (DIGIT_BITS * len(letters)))
                    if least is None or here < least:
                        least = here
            new.append(least)
        best = new
    return best


@lru_cache(maxsize=4096)
def _head(letters: str, bits: int) -> int:
    return number(0, letters, bits)


def closed(bits: int) -> list[int | None]:
    """Integers of the end of a conversation, by state."""
    return [number(INSERT * CLOSING[state], "I" * CLOSING[state], bits) for state in range(4)]


@lru_cache(maxsize=1 << 14)
def whole(signs: str) -> tuple[int, str]:
    """Cost and audit of a conversation of one segment."""
    bits = width(len(signs))
    return letters_of(paths(signs, closed(bits), bits)[START], bits)


@lru_cache(maxsize=1 << 8)
def across(signs: str) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """Cost and letters of a segment from every state to every state."""
    bits = width(len(signs))
    columns = [paths(signs, [0 if s == end else None for s in range(4)], bits) for end in range(4)]
    return tuple(tuple(None if columns[end][s] is None else letters_of(columns[end][s], bits) for end in range(4)) for s in range(4))


def joined(segments: list[tuple], rows: int) -> tuple[int, list[tuple[int, str]]]:
    """Cost of a conversation, and for each of its segments the state it starts in and its letters."""
    bits = width(rows)
    best: list[int | None] = closed(bits)
    chosen: list[list[int | None]] = []
    for table in reversed(segments):
        new, ends = [], []
        for state in range(4):
            options = [(after(best[end], *table[state][end], bits), end) for end in range(4) if table[state][end] is not None]
            weight, end = min(options) if options else (None, None)
            new.append(weight)
            ends.append(end)
        best = new
        chosen.append(ends)
    state, out = START, []
    for table, ends in zip(segments, reversed(chosen)):
        out.append((state, table[state][ends[state]][1]))
        state = ends[state]
    out.append((state, "I" * CLOSING[state]))
    return best[START] >> bits, out


def lines(state: int, letters: str, signs: str) -> list[tuple[int, str | None]]:
    """What comes out of a segment's letters: row (-1: inserted) and its new role (None: kept)."""
    out, row = [], 0
    for letter in letters:
        if letter == "D":
            row += 1
            continue
        if letter == "K":
            state = STEPS[state][ROLES[int(signs[row], 16) % 4]]
            out.append((row, None))
        else:
            state = ASSISTANT if state == USER else USER
            out.append((row if letter == "R" else -1, ROLE_OF[state]))
        row += letter != "I"
    return out


# --- on tables


def conversation_key(column: Column) -> Column:
    """Never null, and different for null and any id."""
    return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), column.cast("string")))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of the rows that are left after the stated damage."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("hit") == 3, 2).otherwise(1)))
    return hit.where("hit <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_")).drop("_")


def ordered(rows: DataFrame, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """Staged: the rows with ``c`` (key of the conversation), ``at`` (place in the order) and ``segment``.

    Rows of one conversation and turn are in order of role and text.
    """
    order = ["c", "turn", "role", "text"]
    spread = rows.withColumn("c", conversation_key(F.col("conv_id")))
    spread = spread.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    # Partition number and row number in one: increasing along the order.
    numbered = spread.withColumn("at", F.monotonically_increasing_id())
    return stage(numbered.withColumn("segment", F.shiftright("at", segment_bits)), "ordered")


def signs(rows: DataFrame) -> DataFrame:
    """``c, at, segment, sign`` of ordered rows: the first fault of each."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    content = F.struct(F.sha2("text", 256).alias("sha"), "role")
    seen = rows.select("c", "at", "segment", "role", content.alias("content"), (bare == "").alias("blank"), bare.substr(-1, 1).isin(".", "!", "?").alias("ends"))
    # Blank rows are settled, so their many equal texts stay out; the least place is combined before the exchange.
    first = seen.where("not blank").groupBy("c", "content").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    fault = F.when(F.col("blank"), BLANK).when(F.coalesce(F.col("at") > F.col("first"), F.lit(False)), REPEAT).when(F.col("ends"), SOUND).otherwise(CUT)
    role = F.coalesce(F.nullif(F.instr(F.lit(ROLES), F.substring("role", 1, 1)), F.lit(0)) - 1, F.lit(3))
    role = F.when(F.col("role") == "", 3).otherwise(role)  # an empty text is found at the first place
    return seen.join(first, ["c", "content"], "left").select("c", "at", "segment", F.lower(F.hex(4 * fault + role)).alias("sign"))


def segments(marked: DataFrame) -> DataFrame:
    """``c, segment, first, signs``: the least place and the signs in order, of at most 2 ** SEGMENT_BITS rows."""
    got = marked.groupBy("c", "segment").agg(F.array_sort(F.collect_list(F.struct("at", "sign"))).alias("s"))
    return got.select("c", "segment", F.col("s")[0]["at"].alias("first"), F.array_join(F.col("s.sign"), "").alias("signs"))


def counts_of(signs: str) -> tuple[int, int, int, int]:
    """Blank, repeated and truncated rows, and illegal neighbours within."""
    codes = [divmod(int(s, 16), 4) for s in signs]
    faults = [f for f, _ in codes]
    names = [ROLES[r] if r < 3 else "" for _, r in codes]
    illegal = sum(pair not in LEGAL for pair in zip(names, names[1:]))
    return faults.count(BLANK), faults.count(REPEAT), faults.count(CUT), illegal


_ENDS = "array<struct<cost:bigint,letters:string>>"
SOLVED = "c string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, parts array<struct<segment:bigint,first:bigint,state:int,letters:string,signs:string>>"
_SOLVED = pa.schema(
    [
        ("c", pa.string()),
        *((n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()),
        ("parts", pa.list_(pa.struct([("segment", pa.int64()), ("first", pa.int64()), ("state", pa.int32()), ("letters", pa.string()), ("signs", pa.string())]))),
    ]
)
_counts = lru_cache(maxsize=1 << 14)(counts_of)


def row_of(c: str, pieces: list[dict]) -> dict:
    """One conversation solved from its segments in order."""
    counts = [sum(x) for x in zip(*(_counts(p["signs"]) for p in pieces))]
    counts[3] += sum(_counts(a["signs"][-1] + b["signs"][0])[3] for a, b in zip(pieces, pieces[1:]))
    if len(pieces) == 1:
        cost, audit = whole(pieces[0]["signs"])
        parts = [(START, audit)]
    else:
        tables = [[[None if x is None else (x["cost"], x["letters"]) for x in p["ends"][4 * s : 4 * s + 4]] for s in range(4)] for p in pieces]
        cost, parts = joined(tables, sum(len(p["signs"]) for p in pieces))
        audit = "".join(letters for _, letters in parts)
        # What closes the pattern belongs to the last segment.
        parts[-2:] = [(parts[-2][0], parts[-2][1] + parts[-1][1])]
    return {
        "c": c,
        **dict(zip(("blank", "duplicate", "truncated", "illegal"), counts)),
        "cost": cost,
        "audit": audit,
        "parts": [{"segment": p["segment"], "first": p["first"], "state": state, "letters": letters, "signs": p["signs"]} for p, (state, letters) in zip(pieces, parts)],
    }


def solved(cut: DataFrame) -> DataFrame:
    """Staged: per conversation the counts, cost and audit, and per segment its start state and letters.

    Segments of conversations that have several are solved where they lie; what meets then are their
    letters, which the audit of the conversation holds in one cell anyway.
    """
    ship(cut.sparkSession)

    def ends(batches):
        for batch in batches:
            found = [None if alone else [x and {"cost": x[0], "letters": x[1]} for row in across(signs_) for x in row] for alone, signs_ in zip(*(batch.column(n).to_pylist() for n in ("alone", "signs")))]
            kind = pa.list_(pa.struct([("cost", pa.int64()), ("letters", pa.string())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("c", "segment", "first", "signs")), pa.array(found, kind)], names=["c", "segment", "first", "signs", "ends"])

    def rows(batches):
        for batch in batches:
            made = [row_of(c, sorted(pieces, key=lambda p: p["segment"])) for c, pieces in zip(batch.column("c").to_pylist(), batch.column("pieces").to_pylist())]
            yield pa.RecordBatch.from_pylist(made, schema=_SOLVED)

    cut = stage(cut, "segments")
    several = cut.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c", F.lit(False).alias("alone"))
    told = cut.join(several, "c", "left").select("c", "segment", "first", "signs", F.coalesce("alone", F.lit(True)).alias("alone"))
    tables = told.mapInArrow(ends, f"c string, segment bigint, first bigint, signs string, ends {_ENDS}")
    together = tables.groupBy("c").agg(F.collect_list(F.struct("segment", "first", "signs", "ends")).alias("pieces"))
    return stage(together.mapInArrow(rows, SOLVED), "solved")


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``c, place, role, text`` of all repaired rows; ``place`` orders the rows of a conversation.

    ``rows`` are ordered rows, ``plan`` what ``solved`` gives of them. Inserted rows have an empty text.
    """
    ship(rows.sparkSession)

    def steps(batches):
        for batch in batches:
            made = {"c": [], "segment": [], "k": [], "at": [], "new": []}
            for c, segment, first, state, letters, signs_ in zip(*(batch.column(n).to_pylist() for n in ("c", "segment", "first", "state", "letters", "signs"))):
                for k, (row, new) in enumerate(lines(state, letters, signs_)):
                    for name, value in zip(made, (c, segment, k, None if row < 0 else first + row, new)):
                        made[name].append(value)
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made.values(), kinds)], names=list(made))

    parts = plan.select("c", F.explode("parts").alias("p")).select("c", "p.*")
    made = parts.mapInArrow(steps, "c string, segment bigint, k int, at bigint, new string")
    placed = stage(made.select("c", F.struct("segment", "k").alias("place"), "at", "new"), "steps")  # no texts
    kept = placed.where("at is not null").join(rows.select("at", "role", "text"), "at")
    old = kept.select("c", "place", F.coalesce("new", "role").alias("role"), "text")
    put = placed.where("at is null").select("c", "place", F.col("new").alias("role"), F.lit("").alias("text"))
    return old.unionByName(put)


def digests(fixed: DataFrame) -> DataFrame:
    """``c, sha``: hash of the repaired lines of each conversation, one running hash over its rows in order."""

    def in_task(batches):
        open_key, running = None, None
        for batch in batches:
            keys, shas = [], []
            for c, line in zip(batch.column("c").to_pylist(), batch.column("line").to_pylist()):
                if c != open_key:
                    if running is not None:
                        keys.append(open_key)
                        shas.append(running.hexdigest())
                    open_key, running = c, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(shas, pa.string())], names=["c", "sha"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_key], pa.string()), pa.array([running.hexdigest()], pa.string())], names=["c", "sha"])

    named = fixed.select("c", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    return named.repartition("c").sortWithinPartitions("c", "place").drop("place").mapInArrow(in_task, "c string, sha string")


def gaps(rows: DataFrame) -> DataFrame:
    """``c, gaps``: turns that are missing between the first and the last one."""
    turns = rows.where("turn is not null").select("c", "turn").distinct()
    return turns.groupBy("c").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))


def repair(rows: DataFrame, segment_bits: int = SEGMENT_BITS) -> tuple[DataFrame, DataFrame]:
    """Of ``conv_id, turn, role, text``: the ordered rows, and the solved conversations.

    A null turn comes first; a null role or text counts as one space, and a null ``conv_id`` is a
    conversation of its own. Rows of one conversation and turn are taken in order of role and
    text; other columns are ignored; an empty table gives empty results.
    """
    space = F.lit(" ")
    whole_rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    placed = ordered(whole_rows, segment_bits)
    return placed, solved(segments(signs(placed)))


def report(conversations: DataFrame, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """A row per conversation of the table: what the stated damage left broken, and the repair.

    Conversations without a row after the damage have zeros, an empty audit and the hash of
    nothing.
    """
    placed, plan = repair(damaged(conversations), segment_bits)
    shas = digests(repaired(placed, plan))
    all_ids = conversations.select("conv_id").distinct().withColumn("c", conversation_key(F.col("conv_id")))
    numbers = ("blank", "duplicate", "truncated", "illegal", "cost")
    made = all_ids.join(gaps(placed), "c", "left").join(plan.drop("parts"), "c", "left").join(shas, "c", "left")
    zero = lambda n: F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n)
    return made.select(
        "conv_id",
        zero("gaps"),
        *[zero(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
